"""Schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType()), "array<float>": T.ArrayType(T.FloatType())}


def _struct(columns: str) -> T.StructType:
    """Of "name type, ..."; unlike ``fromDDL`` it needs no session, so workers can import it."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


#: The upstream manifest: data sets, their files, and each file's status and hash.
MANIFEST_JSON = T.StructType().add("raw_datasets", T.MapType(T.StringType(), T.StructType().add("files", T.MapType(T.StringType(), _struct("status string, sha256 string")))))
MANIFEST = _struct("position long, doc_id string, dataset string, relative_path string, path string, status string, hash string")
STATE = _struct("doc_id string, status string, hash string, error string, at string")

#: What chunkers keep of a unit's place in its document.
PLACE = (
    "paragraph_ref string, paragraph_title string, section_heading string, document_title string, chapter_path array<string>, "
    "address string, url string, cross_refs array<string>"
)
#: Units in document order, for each tier: what folds and splits run on. ``parts`` is null without a list.
UNITS = _struct(f"document_id string, tier int, section int, seq int, unit_id string, ledd_number int, {PLACE}, text string, parts array<string>, error string")
#: Units with what enrichers read besides; a copy of the header for each, so it is kept on demand only.
MARKED_UNITS = T.StructType([*UNITS.fields, *_struct("header string, markup string, hrefs array<string>").fields])
_CHUNK = (
    "chunk_id string, document_id string, dataset_name string, content string, token_count int, section_heading string, absolute_address string, "
    "split_reason string, parent_chunk_id string, source_hash string, cross_refs array<string>"
)
CHUNK = _struct(_CHUNK)
ENRICHED = _struct(f"{_CHUNK}, embedding array<float>, embedding_model string, embedded_at string")
#: Columns without which a stored row is invalid.
REQUIRED = ("chunk_id", "document_id", "content", "token_count", "embedding", "embedding_model", "embedded_at")
