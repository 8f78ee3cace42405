"""The catalogue: queries over the driver's tables, and their DuckDB SQL.

``documents`` stand for legal documents (a line is a unit, the text's SHA-256 the source hash), ``labels``
for documents that were processed before, ``embeddings`` for stored chunks, ``pages`` for markup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import enrich, text
from .operators import embed, embed_cache, folds, state, vector_index
from .plans import pipeline
from .sources import html, manifest, store
from .streaming import changes, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(c: Column) -> Column:
    return F.sha2(c, 256)


# -- shared pieces of SQL -------------------------------------------------------------------------------

_COUNT = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]'))"
_LINES = f"""lines AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
units AS (SELECT *, {_COUNT.format("unit")}::BIGINT AS t FROM lines)"""
_TURNS = f"""units AS (SELECT conv_id AS doc, text AS unit, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, {_COUNT.format("text")}::BIGINT AS t FROM conversations)"""
_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: s <> '')"


def merge_ctes(units: str, low: int, high: int) -> str:
    """F1 in SQL over ``units`` (doc, pos, t, ...): ``placed`` has each unit's chunk (gid), ``late`` marks the one that joined at the end."""
    return f"""
WITH RECURSIVE {units},
r AS (
  SELECT DISTINCT doc, 0::BIGINT AS pos, 0::BIGINT AS total, 0::BIGINT AS n, 0::BIGINT AS nxt, 0::BIGINT AS last, -1::BIGINT AS gid FROM units
  UNION ALL
  SELECT doc, pos, CASE WHEN flush THEN 0 ELSE total END, CASE WHEN flush THEN 0 ELSE n END, nxt + flush::BIGINT, CASE WHEN flush THEN total ELSE last END, nxt
  FROM (SELECT r.doc, u.pos, r.total + u.t AS total, r.n + 1 AS n, r.nxt, r.last,
               r.total + u.t >= {low} OR r.total + u.t + (r.total + u.t) // (r.n + 1) > {high} AS flush
        FROM r JOIN units u ON u.doc = r.doc AND u.pos = r.pos + 1)),
tail AS (SELECT doc, max(pos) AS pos FROM r GROUP BY doc),
joins AS (SELECT doc, pos FROM r JOIN tail USING (doc, pos) WHERE n = 1 AND total < {low} AND nxt > 0 AND last + total <= {high}),
placed AS (SELECT r.doc, r.pos, CASE WHEN j.doc IS NULL THEN gid ELSE gid - 1 END AS gid, j.doc IS NOT NULL AS late FROM r LEFT JOIN joins j ON j.doc = r.doc AND j.pos = r.pos WHERE r.gid >= 0)"""


def _merge_sql(units: str, low: int, high: int) -> str:
    return f"""{merge_ctes(units, low, high)}
SELECT doc, gid AS chunk, count(*) AS n_units, nullif(count(*) FILTER (NOT late), 1) AS merged_count, sum(t)::BIGINT AS tokens, sha256(string_agg(unit, chr(10) || chr(10) ORDER BY pos)) AS content_sha
FROM placed JOIN units USING (doc, pos) GROUP BY doc, gid
"""


def _chunks(lists: DataFrame, groups: Column) -> DataFrame:
    """(doc, chunk, n_units, merged_count, tokens, content_sha) of rows with ``units`` and ``tokens``."""
    made = F.transform("groups", lambda g: F.struct((g["end"] - g["start"]).cast("long").alias("n_units"), g["merged_count"].cast("long").alias("merged_count"), g["tokens"].cast("long").alias("tokens"), sha(folds.joined(F.col("units"), g, "\n\n")).alias("content_sha")))
    return lists.withColumn("groups", groups).select("doc", F.posexplode(made).alias("chunk", "c")).select("doc", F.col("chunk").cast("long").alias("chunk"), "c.*")


def line_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, units, tokens): a document's lines in place, so that folding them needs no shuffle."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.split("text", "\n", -1).alias("units"))
    return docs.withColumn("tokens", F.transform("units", lambda u: text.token_count(u)))


MERGE_LOW, MERGE_HIGH, TARGET = 60, 500, 120


@query(_merge_sql(_LINES, MERGE_LOW, MERGE_HIGH))
def merge_small_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(line_units(spark, sf_dir), folds.merge_groups(F.col("tokens"), MERGE_LOW, MERGE_HIGH))


@query(_merge_sql(_TURNS, MERGE_LOW, MERGE_HIGH))
def merge_small_chunks_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("u"))
    lists = turns.select("doc", F.transform("u", lambda u: u["text"]).alias("units"))
    return _chunks(lists.withColumn("tokens", F.transform("units", lambda u: text.token_count(u))), folds.merge_groups(F.col("tokens"), MERGE_LOW, MERGE_HIGH))


@query(f"""
WITH RECURSIVE {_LINES},
r AS (
  SELECT DISTINCT doc, 0::BIGINT AS pos, 0::BIGINT AS total, 0::BIGINT AS n, 0::BIGINT AS gid FROM units
  UNION ALL
  SELECT r.doc, u.pos, CASE WHEN r.n > 0 AND r.total + u.t > {TARGET} THEN u.t ELSE r.total + u.t END,
         CASE WHEN r.n > 0 AND r.total + u.t > {TARGET} THEN 1 ELSE r.n + 1 END, r.gid + (r.n > 0 AND r.total + u.t > {TARGET})::BIGINT
  FROM r JOIN units u ON u.doc = r.doc AND u.pos = r.pos + 1)
SELECT doc, gid AS chunk, count(*) AS n_units, count(*) AS merged_count, sum(t)::BIGINT AS tokens, sha256(string_agg(unit, chr(10) || chr(10) ORDER BY pos)) AS content_sha
FROM r JOIN units USING (doc, pos) GROUP BY doc, gid
""")
def group_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(line_units(spark, sf_dir), folds.target_groups(F.col("tokens"), TARGET))


@query(f"""
WITH RECURSIVE s AS (SELECT doc_id AS doc, {_SENTENCES} AS ss FROM documents),
p AS (SELECT doc, ss, len(ss)::BIGINT AS n, list_transform(ss, lambda x: {_COUNT.format("x")}::BIGINT) AS ts, greatest(1, (len(ss) * 20) // 100)::BIGINT AS back FROM s),
q AS (SELECT *, list_prepend(0::BIGINT, list_transform(range(1, n + 1), lambda k: list_sum(ts[1:k])::BIGINT)) AS sums FROM p),
r AS (
  SELECT doc, 0::BIGINT AS i, len(list_filter(sums, lambda x: x <= 100))::BIGINT - 1 AS j, 0::BIGINT AS step FROM q WHERE n > 0
  UNION ALL
  SELECT doc, i, len(list_filter(sums, lambda x: x <= sums[i + 1] + 100))::BIGINT - 1, step
  FROM (SELECT r.doc, greatest(r.i + 1, r.j - q.back) AS i, q.sums, q.n, r.step + 1 AS step FROM r JOIN q USING (doc)) WHERE i < n)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY i) AS part, i AS first, j AS stop, (sums[j + 1] - sums[i + 1])::BIGINT AS tokens, sha256(array_to_string(ss[i + 1 : j], ' ')) AS content_sha
FROM r JOIN q USING (doc) WHERE j > i
""")
def sentence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), text.sentences(F.col("text")).alias("s"))
    docs = docs.withColumn("tokens", F.transform("s", lambda x: text.token_count(x).cast("int")))
    total = lambda g: F.aggregate(F.slice("tokens", g["start"] + 1, g["end"] - g["start"]), F.lit(0).cast("long"), lambda a, t: a + t)
    made = F.transform("w", lambda g: F.struct(g["start"].cast("long").alias("first"), g["end"].cast("long").alias("stop"), total(g).alias("tokens"), sha(folds.joined(F.col("s"), g, " ")).alias("content_sha")))
    rows = docs.withColumn("w", folds.sentence_windows(F.col("tokens"), 100, 0.2)).select("doc", F.posexplode(made).alias("n", "c"))
    return rows.select("doc", (F.col("n") + 1).cast("long").alias("part"), "c.*")


@query(f"SELECT doc_id, len(s)::BIGINT AS n_sentences, sha256(array_to_string(s, chr(10))) AS sentences_sha FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return docs.select("doc_id", F.size("s").cast("long").alias("n_sentences"), sha(F.array_join("s", "\n")).alias("sentences_sha"))


@query(f"""
WITH s AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents),
x AS (SELECT doc_id, unnest(ss) AS t, generate_subscripts(ss, 1) AS pos FROM s)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS part, {_COUNT.format("t")}::BIGINT AS tokens, sha256(t) AS content_sha FROM x WHERE {_COUNT.format("t")} <= 30
""")
def sentence_chunks_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    kept = F.filter(F.transform("s", lambda x: F.struct(x.alias("t"), text.token_count(x).cast("long").alias("n"))), lambda x: x["n"] <= 30)
    return docs.select("doc_id", F.posexplode(kept).alias("i", "x")).select("doc_id", (F.col("i") + 1).cast("long").alias("part"), F.col("x.n").alias("tokens"), sha(F.col("x.t")).alias("content_sha"))


@query(f"SELECT doc_id, {_COUNT.format('text')}::BIGINT AS tokens FROM documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).cast("long").alias("tokens"))


@query(r"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]') AS ts FROM documents),
s AS (SELECT doc_id, ts, unnest(range(0, len(ts), 50)) AS i FROM t)
SELECT doc_id, (i // 50)::BIGINT AS part, sha256(array_to_string(ts[i + 1 : i + 50], ' ')) AS content_sha FROM s
""")
def hard_token_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.hard_split(F.col("text"), 50)).alias("part", "t"))
    return docs.select("doc_id", F.col("part").cast("long").alias("part"), sha(F.col("t")).alias("content_sha"))


@query("""
SELECT doc_id, 'doc' || doc_id || '_chunk_' || (pos - 1) AS chunk_id, 'doc' || doc_id || '_ledd-' || pos AS prefixed_id
FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
""")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("d"), F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    return rows.select("doc_id", F.concat_ws("_chunk_", "d", F.col("i").cast("string")).alias("chunk_id"), F.concat_ws("_", "d", F.concat(F.lit("ledd-"), (F.col("i") + 1).cast("string"))).alias("prefixed_id"))


@query("""
SELECT doc_id, sha256(coalesce(nullif(CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '' END, ''), nullif(CASE doc_id % 2 WHEN 0 THEN source ELSE '' END, ''), coalesce(text, ''))) AS heading_sha,
       coalesce(nullif(CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN lang END, ''), 'a' || doc_id) AS absolute_address FROM documents
""")
def heading_and_address_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, name = F.col("doc_id"), F.col("doc_id").cast("string")
    heading = text.first_truthy(F.when(d % 3 == 0, F.col("text")).when(d % 3 == 1, ""), F.when(d % 2 == 0, F.col("source")).otherwise(""), F.coalesce("text", F.lit("")))
    address = text.first_truthy(F.when(d % 4 == 0, "").when(d % 4 == 1, F.col("lang")), F.concat(F.lit("a"), name))
    return table(spark, sf_dir, "documents").select("doc_id", sha(heading).alias("heading_sha"), address.alias("absolute_address"))


# -- stored chunks --------------------------------------------------------------------------------------


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as enriched chunks: ten documents by label, one hash for each two of them."""
    v, label = F.col("vec_id").cast("string"), F.col("label").cast("string")
    refs = F.when(F.col("vec_id") % 3 == 0, F.array(F.concat(F.lit("lov/"), v), F.lit("lov/x"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("c"), v).alias("chunk_id"), F.concat(F.lit("doc"), label).alias("document_id"), F.when(F.col("label") % 2 == 0, "laws").alias("dataset_name"), F.concat(F.lit("text "), v).alias("content"),
        (F.col("vec_id") % 50).cast("int").alias("token_count"), F.concat(F.lit("h"), F.floor(F.col("label") / 2).cast("string")).alias("source_hash"), refs.alias("cross_refs"),
        F.col("embedding").cast("array<float>").alias("embedding"), F.lit("m").alias("embedding_model"), F.lit("2024-01-01T00:00:00+00:00").alias("embedded_at"),
    )
    return store.complete(rows)


def _filled(spark: SparkSession, rows: DataFrame, layout: str = "store") -> store.ChunkStore | store.JsonlStore | store.FlatTable:
    """A new store that holds ``rows``."""
    kept = store.open_store(spark, store.scratch_path(spark, "queries"), layout)
    kept.upsert(rows)
    return kept


_STORED = """stored AS (SELECT 'c' || vec_id AS chunk_id, 'doc' || label AS document_id, CASE WHEN label % 2 = 0 THEN 'laws' ELSE '' END AS dataset_name, 'text ' || vec_id AS content,
  (vec_id % 50)::INT AS token_count, 'h' || (label // 2) AS source_hash, CASE WHEN vec_id % 3 = 0 THEN 'lov/' || vec_id || ',lov/x' ELSE '' END AS refs FROM embeddings)"""


@query(f"""WITH {_STORED} SELECT chunk_id, document_id, dataset_name, content, token_count, source_hash, refs AS cross_refs, '' AS parent_chunk_id, 'none' AS split_reason,
  CASE WHEN dataset_name <> '' THEN 'data/extracted/' || dataset_name || '/' || document_id || '.xml' ELSE '' END AS file_path FROM stored""")
def flat_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.flat_metadata(stored(spark, sf_dir)).select("chunk_id", "document_id", "dataset_name", "content", "token_count", "source_hash", "cross_refs", "parent_chunk_id", "split_reason", "file_path")


@query(f"WITH {_STORED} SELECT chunk_id, token_count, refs AS cross_refs, (length(refs) > 0)::INT * 2 AS n_refs FROM stored")
def cross_refs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.from_flat(store.flat_metadata(stored(spark, sf_dir))).select("chunk_id", "token_count", F.array_join("cross_refs", ",").alias("cross_refs"), F.size("cross_refs").alias("n_refs"))


@query(f"""WITH {_STORED}, new AS (SELECT chunk_id, document_id, 'new ' || content AS content, token_count + 1 AS token_count FROM stored WHERE token_count % 5 = 0
  UNION ALL SELECT 'n' || chunk_id, document_id, content, token_count FROM stored WHERE token_count % 7 = 0)
SELECT chunk_id, document_id, content, token_count FROM stored WHERE chunk_id NOT IN (SELECT chunk_id FROM new) UNION ALL SELECT * FROM new""")
def upsert_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = stored(spark, sf_dir)
    changed = have.where("token_count % 5 = 0").withColumns({"content": F.concat(F.lit("new "), "content"), "token_count": F.col("token_count") + 1})
    added = have.where("token_count % 7 = 0").withColumn("chunk_id", F.concat(F.lit("n"), "chunk_id"))
    kept = _filled(spark, have)
    kept.upsert(changed.unionByName(added), by="chunk_id")
    return kept.read().select("chunk_id", "document_id", "content", "token_count")


@query(f"WITH {_STORED} SELECT chunk_id, document_id FROM stored WHERE document_id NOT IN ('doc1', 'doc3')")
def delete_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = spark.range(1).select(F.explode(F.array(F.lit("doc1"), F.lit("doc3"))).alias("document_id"))
    kept = _filled(spark, stored(spark, sf_dir))
    kept.delete_documents(gone)
    return kept.read().select("chunk_id", "document_id")


@query(f"WITH {_STORED} SELECT count(*) AS chunks, count(DISTINCT document_id) AS documents, count(DISTINCT source_hash) AS hashes FROM stored")
def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir)).read().agg(F.count("*").alias("chunks"), F.count_distinct("document_id").alias("documents"), F.count_distinct("source_hash").alias("hashes"))


@query(f"WITH {_STORED} SELECT DISTINCT document_id FROM stored")
def distinct_document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir)).document_ids()


@query(f"WITH {_STORED} SELECT chunk_id, document_id FROM stored WHERE source_hash = 'h1'")
def chunks_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir), "jsonl").by_hash("h1").select("chunk_id", "document_id")


@query(f"WITH {_STORED} SELECT chunk_id, source_hash FROM stored WHERE document_id = 'doc2'")
def chunks_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir)).by_document("doc2").select("chunk_id", "source_hash")


@query(f"""WITH {_STORED}, new AS (SELECT chunk_id, document_id, 'new ' || content AS content, source_hash FROM stored WHERE token_count % 5 = 0
  UNION ALL SELECT 'n' || chunk_id, document_id, content, 'h9' FROM stored WHERE token_count % 7 = 0)
SELECT chunk_id, document_id, content, source_hash FROM (SELECT chunk_id, document_id, content, source_hash FROM stored WHERE chunk_id NOT IN (SELECT chunk_id FROM new) UNION ALL SELECT * FROM new) WHERE document_id <> 'doc4'""")
def jsonl_upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = stored(spark, sf_dir)
    changed = have.where("token_count % 5 = 0").withColumn("content", F.concat(F.lit("new "), "content"))
    added = have.where("token_count % 7 = 0").withColumns({"chunk_id": F.concat(F.lit("n"), "chunk_id"), "source_hash": F.lit("h9")})
    kept = _filled(spark, have, "jsonl")
    kept.upsert(changed.unionByName(added), by="chunk_id")
    kept.delete_documents(spark.range(1).select(F.lit("doc4").alias("document_id")))
    return kept.read().select("chunk_id", "document_id", "content", "source_hash")


@query(f"WITH {_STORED} SELECT DISTINCT source_hash FROM stored")
def distinct_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir)).hashes()


@query(f"WITH {_STORED} SELECT chunk_id, document_id FROM stored ORDER BY chunk_id LIMIT 40 OFFSET 20")
def store_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, stored(spark, sf_dir)).page(40, 20).select("chunk_id", "document_id")


@query(f"""WITH {_STORED} SELECT chunk_id, document_id, dataset_name, content, token_count, source_hash, refs AS cross_refs FROM stored WHERE token_count % 2 = 1
  UNION ALL SELECT chunk_id, document_id, dataset_name, 'old', token_count, source_hash, refs FROM stored WHERE token_count % 2 = 0""")
def migrate_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with half of the chunks go to a flat table that holds all; what comes of it goes on to the store."""
    root, have = store.scratch_path(spark, "queries"), stored(spark, sf_dir)
    store.open_store(spark, root, "flat").upsert(have.withColumn("content", F.lit("old")))
    store.open_store(spark, root, "jsonl").upsert(have.where("token_count % 2 = 1"))
    pipeline.migrate(spark, "jsonl", "flat", root)
    pipeline.migrate(spark, "flat", "store", root)
    rows = store.open_store(spark, root, "store").read()
    return rows.select("chunk_id", "document_id", "dataset_name", "content", "token_count", "source_hash", F.array_join("cross_refs", ",").alias("cross_refs"))


# -- manifest and state ---------------------------------------------------------------------------------


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a manifest; what their status is follows from their number."""
    k = F.col("doc_id") % 10
    status = F.when(k == 0, "removed").when(k < 3, "modified").when(k < 6, "added").when(k == 6, None).otherwise("unchanged")
    name = F.concat("lang", F.lit("/doc-"), F.col("doc_id").cast("string"), F.lit(".v1.xml"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("position"), text.stem(name).alias("doc_id"), text.plain_dataset(F.concat("source", F.lit(".tar.bz2"))).alias("dataset"), status.alias("status"), sha(F.col("text")).alias("hash")
    )


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as processing state: most with the present hash, some with an old one, toxic ones failed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    old = F.col("doc_id") % 5 == 0
    return rows.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".v1")).alias("doc_id"), F.when(F.col("toxic") == 1, "failed").otherwise("processed").alias("status"),
        F.when(old, "old").otherwise(sha(F.col("text"))).alias("hash"), F.when(F.col("toxic") == 1, "e").alias("error"), F.lit("t0").alias("at"),
    )


_FILES = """files AS (SELECT doc_id AS position, 'doc-' || doc_id || '.v1' AS doc_id, source AS dataset, CASE WHEN doc_id % 10 = 0 THEN 'removed' WHEN doc_id % 10 < 3 THEN 'modified' WHEN doc_id % 10 < 6 THEN 'added'
  WHEN doc_id % 10 = 6 THEN NULL ELSE 'unchanged' END AS status, sha256(text) AS hash FROM documents)"""
_STATE = """st AS (SELECT 'doc-' || doc_id || '.v1' AS doc_id, CASE WHEN toxic = 1 THEN 'failed' ELSE 'processed' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'old' ELSE sha256(text) END AS hash,
  CASE WHEN toxic = 1 THEN 'e' END AS error, 't0' AS at FROM labels JOIN documents USING (doc_id))"""
_DONE = "SELECT 1 FROM st WHERE st.status = 'processed' AND st.doc_id = files.doc_id AND st.hash = files.hash"
_FILE_COLUMNS = ("position", "doc_id", "dataset", "hash")


@query(f"WITH {_FILES} SELECT position, doc_id, dataset, hash FROM files WHERE status IN ('added', 'modified')")
def manifest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.changed_files(file_rows(spark, sf_dir)).select(*_FILE_COLUMNS)


@query(f"WITH {_FILES} SELECT position, doc_id, dataset, hash FROM files WHERE status IS DISTINCT FROM 'removed'")
def manifest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.all_files(file_rows(spark, sf_dir)).select(*_FILE_COLUMNS)


@query(f"WITH {_FILES} SELECT doc_id, dataset FROM files WHERE status = 'removed'")
def manifest_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.removed_files(file_rows(spark, sf_dir))


@query(f"WITH {_FILES} SELECT position, doc_id, dataset, hash FROM files WHERE regexp_matches(dataset, '^src1[^/]*$')")
def manifest_dataset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.in_dataset(file_rows(spark, sf_dir), "src1*").select(*_FILE_COLUMNS)


@query(f"WITH {_FILES}, c AS (SELECT count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'modified') AS modified, count(*) FILTER (status = 'removed') AS removed FROM files) SELECT *, added + modified AS total_changed FROM c")
def sync_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sync_statistics(file_rows(spark, sf_dir))


@query(f"WITH {_FILES}, {_STATE} SELECT position, doc_id, dataset, hash FROM files WHERE status IS DISTINCT FROM 'removed' AND NOT EXISTS ({_DONE})")
def identify_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.identify(file_rows(spark, sf_dir), state_rows(spark, sf_dir)).select(*_FILE_COLUMNS)


@query(f"WITH {_FILES}, {_STATE} SELECT position, doc_id, dataset, hash FROM files WHERE status IN ('added', 'modified') AND NOT EXISTS ({_DONE})")
def identify_changed_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.identify(file_rows(spark, sf_dir), state_rows(spark, sf_dir), compat=True).select(*_FILE_COLUMNS)


@query(f"WITH {_FILES} SELECT position, doc_id, dataset, hash FROM files WHERE status IS DISTINCT FROM 'removed'")
def identify_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.identify(file_rows(spark, sf_dir), state_rows(spark, sf_dir), force=True).select(*_FILE_COLUMNS)


@query(f"WITH {_FILES}, {_STATE} SELECT position, doc_id, dataset, hash FROM files WHERE status IS DISTINCT FROM 'removed' AND NOT EXISTS ({_DONE}) ORDER BY position LIMIT 25")
def identify_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.identify(file_rows(spark, sf_dir), state_rows(spark, sf_dir), limit=25).select(*_FILE_COLUMNS)


_OUTCOMES = f"""todo AS (SELECT * FROM files WHERE status IS DISTINCT FROM 'removed' AND NOT EXISTS ({_DONE})),
o AS (SELECT doc_id, CASE WHEN position % 7 = 0 THEN 'failed' ELSE 'processed' END AS status, hash, CASE WHEN position % 7 = 0 THEN 'bad' END AS error, 't1' AS at FROM todo),
after AS (SELECT * FROM (SELECT * FROM st WHERE doc_id NOT IN (SELECT doc_id FROM o) UNION ALL SELECT * FROM o) WHERE doc_id NOT IN (SELECT doc_id FROM files WHERE status = 'removed'))"""


def state_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, before = file_rows(spark, sf_dir), state_rows(spark, sf_dir)
    outcomes = state.identify(files, before).select("doc_id", "hash", F.when(F.col("position") % 7 == 0, "bad").alias("error"), F.lit("t1").alias("at"))
    return state.remove_documents(state.merge_outcomes(before, outcomes), manifest.removed_files(files))


@query(f"WITH {_FILES}, {_STATE}, {_OUTCOMES} SELECT * FROM after")
def state_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_after(spark, sf_dir)


@query(f"WITH {_FILES}, {_STATE}, {_OUTCOMES} SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'failed') AS failed FROM after")
def state_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.statistics(state_after(spark, sf_dir))


_SIDES = """a AS (SELECT DISTINCT doc_id FROM st WHERE status = 'processed'), b AS (SELECT 'doc-' || doc_id || '.v1' AS doc_id FROM documents WHERE doc_id % 3 <> 0),
f AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NOT NULL AS s, b.doc_id IS NOT NULL AS t FROM a FULL JOIN b ON a.doc_id = b.doc_id)"""


def _stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("doc_id % 3 <> 0").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".v1")).alias("document_id"))


@query(f"WITH {_STATE}, {_SIDES} SELECT count(*) FILTER (s) AS state_documents, count(*) FILTER (t) AS store_documents, count(*) FILTER (NOT t) AS missing, count(*) FILTER (NOT s) AS orphans, count(*) FILTER (NOT (s AND t)) = 0 AS is_consistent FROM f")
def validate_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.validation_report(state_rows(spark, sf_dir), _stored_documents(spark, sf_dir))


@query(f"WITH {_STATE}, {_SIDES} SELECT doc_id, CASE WHEN t THEN 'orphan' ELSE 'missing' END AS side FROM f WHERE NOT (s AND t)")
def validate_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.differences(state_rows(spark, sf_dir), _stored_documents(spark, sf_dir))


@query("SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 100)::BIGINT AS batch FROM documents")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", embed.batch_ids(F.col("doc_id"), F.col("source")).cast("long").alias("batch"))


class LetterCounts:
    """How often each of a to z is in a text, in either case: a provider whose vectors SQL can state."""

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.count(chr(c)) + t.count(chr(c - 32))) for c in range(ord("a"), ord("z") + 1)] for t in texts]

    def model_name(self) -> str:
        return "letter-counts"


_LETTERS = ", ".join(f"(2 * len(t) - len(replace(t, '{chr(c)}', '')) - len(replace(t, '{chr(c - 32)}', '')))::BIGINT" for c in range(ord("a"), ord("z") + 1))


@query(f"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents), l AS (SELECT DISTINCT lang AS t FROM documents WHERE lang IS NOT NULL)
SELECT chunk_id, 'letter-counts' AS embedding_model, array_to_string([{_LETTERS}], ' ') AS vector, (SELECT count(DISTINCT t) FROM (SELECT t FROM d UNION ALL SELECT t FROM l))::BIGINT AS n_cached
FROM (SELECT 't' || doc_id AS chunk_id, t FROM d UNION ALL SELECT 'c' || doc_id, t FROM d UNION ALL SELECT 'l' || doc_id, lang FROM d WHERE lang IS NOT NULL)""")
def embedded_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts embedded in one run; in the next they are there again as copies, with one short text that very many chunks have."""
    root = store.scratch_path(spark, "vectors")
    kept, provider = embed_cache.EmbeddingCache(spark, f"{root}/cache"), LetterCounts()
    docs = table(spark, sf_dir, "documents")
    chunk = lambda name, content: docs.select(F.concat(F.lit(name), F.col("doc_id").cast("string")).alias("chunk_id"), F.col(content).alias("content"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("document_id"), F.lit(1).alias("token_count"), *[F.lit("").alias(c) for c in ("dataset_name", "section_heading", "absolute_address", "split_reason", "source_hash", "parent_chunk_id")], F.array().cast("array<string>").alias("cross_refs"))
    first = embed_cache.embed_by_content(chunk("t", "text"), provider, kept, f"{root}/first")
    copies = embed_cache.embed_by_content(chunk("c", "text").unionByName(chunk("l", "lang").where("content is not null")), provider, kept, f"{root}/second")
    rows = first.unionByName(copies).where("error is null")
    size = kept.rows("letter-counts").agg(F.count("*").alias("n_cached"))
    return rows.select("chunk_id", "embedding_model", F.array_join(F.transform("embedding", lambda x: x.cast("long")), " ").alias("vector")).crossJoin(F.broadcast(size))


# -- markup ---------------------------------------------------------------------------------------------

_S = r"[ \t\n\x0b\f\r]+"


def _plain_sql(c: str) -> str:
    out = rf"regexp_replace({c}, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{character}')"
    return f"trim(regexp_replace({out}, '{_S}', ' ', 'g'))"


@query(f"SELECT page_id, {_plain_sql("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title FROM pages")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@query(f"SELECT page_id, sha256({_plain_sql('html')}) AS text_sha FROM pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", sha(html.plain(F.col("html"))).alias("text_sha"))


_HREFS = """regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)"""


@query(f"SELECT page_id, len({_HREFS})::BIGINT AS n, array_to_string({_HREFS}, ' ') AS hrefs FROM pages")
def page_cross_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.size(html.hrefs(F.col("html"))).cast("long").alias("n"), F.array_join(html.hrefs(F.col("html")), " ").alias("hrefs"))


@query(f"SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), lambda x: {_plain_sql('x')}), chr(10)) AS items FROM pages")
def page_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(html.items(F.col("html")), "\n").alias("items"))


_TITLE = "replace(coalesce(text, ''), '<', '(')"


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with the whole text as title, for every second document as short title."""
    title = F.replace(F.coalesce("text", F.lit("")), F.lit("<"), F.lit("("))
    kind = F.when(F.col("doc_id") % 2 == 0, "titleShort").otherwise("title")
    header = F.concat(F.lit('<dl><dd class="dokid">LOV/'), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("20"), F.lpad(F.col("doc_id") % 100, 2, "0"), F.lit("-05-17"))).otherwise("none"), F.lit('-3</dd><dd class="ministry"><ul><li>A '), "lang", F.lit('</li><li> B</li></ul></dd><dd class="'), kind, F.lit('">'), title, F.lit("</dd></dl>"))
    return table(spark, sf_dir, "documents").select("doc_id", header.alias("header"))


@query(f"""SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN sha256(nullif(trim({_TITLE}, ' '), '')) END AS title_sha, CASE WHEN doc_id % 2 = 0 THEN sha256(nullif(trim({_TITLE}, ' '), '')) END AS title_short_sha,
  CASE WHEN doc_id % 2 = 0 THEN '20' || lpad((doc_id % 100)::VARCHAR, 2, '0') || '-05-17' END AS document_date, 'A ' || lang || '|B' AS ministries FROM documents""")
def enrich_document_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.document_info(_headers(spark, sf_dir)).select("doc_id", sha(F.col("title")).alias("title_sha"), sha(F.col("title_short")).alias("title_short_sha"), "document_date", F.array_join("ministries", "|").alias("ministries"))


_CHUNK_ID = "CASE doc_id % 3 WHEN 0 THEN 'kap-1-paragraf-' || doc_id || 'a ' WHEN 1 THEN '' ELSE '§ ' END || coalesce(text, '')"
_PARAGRAPH = r"regexp_extract(name, '(?:paragraf-|§\s*)([0-9]+[a-z]?)', 1)"


@query(f"""SELECT doc_id, '§ ' || nullif({_PARAGRAPH}, '') AS paragraph, nullif(source, '') AS source_url, coalesce(nullif(lang, ''), nullif(source, '')) AS absolute_address,
  nullif(len(name) - len(replace(name, '-', '')), 0) AS depth_level FROM (SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS lang, {_CHUNK_ID} AS name FROM documents)""")
def enrich_location_and_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as ids: marks of paragraphs and dashes wherever they are."""
    d = F.col("doc_id")
    name = F.concat(F.when(d % 3 == 0, F.concat(F.lit("kap-1-paragraf-"), d.cast("string"), F.lit("a "))).when(d % 3 == 1, "").otherwise("§ "), F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "documents").select("doc_id", name.alias("chunk_id"), F.when(d % 2 == 0, F.col("lang")).otherwise("").alias("address"), F.col("source").alias("url"))
    return enrich.hierarchy_info(enrich.location_info(rows)).select("doc_id", "paragraph", "source_url", "absolute_address", "depth_level")


@query(r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0
    THEN list_distinct(regexp_extract_all(array_to_string(list_transform(w, lambda x: 'lov/1999-01-' || lpad((len(x) % 100)::VARCHAR, 2, '0') || '-' || len(x) || '/' || x), ' '), 'lov/[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]+(?:/[^"\s]+)?'))
    ELSE list_transform(list_filter(w, lambda x: len(x) % 3 > 0), lambda x: 'lov/' || x) END AS f FROM t)
SELECT doc_id, CASE WHEN len(f) > 0 THEN sha256(array_to_string(list_sort(f), ' ')) END AS refs_sha, nullif(len(f), 0)::INT AS reference_count FROM r
""")
def enrich_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of a text as a reference in it, or as one of its links, of which every third leads elsewhere."""
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    number = lambda w: F.length(w).cast("string")
    referring = F.array_join(F.transform(words, lambda w: F.concat(F.lit("lov/1999-01-"), F.lpad((F.length(w) % 100).cast("string"), 2, "0"), F.lit("-"), number(w), F.lit("/"), w)), " ")
    links = F.transform(words, lambda w: F.concat(F.when(F.length(w) % 3 > 0, "lov/").otherwise("http://"), w))
    rows = table(spark, sf_dir, "documents").select("doc_id", referring.alias("text"), F.when(F.col("doc_id") % 2 == 1, links).alias("hrefs"))
    return enrich.references(rows).select("doc_id", sha(F.array_join(F.array_sort("outgoing_refs"), " ")).alias("refs_sha"), "reference_count")


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN source WHEN doc_id % 4 < 3 THEN sha256(string_split(coalesce(text, ''), chr(10))[1]) END AS section_heading,
  CASE WHEN doc_id % 5 = 0 OR regexp_matches(coalesce(text, ''), '<article[^>]*class=[''"]changesToParent[''"]') THEN true END AS is_amendment FROM documents
""")
def enrich_section_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text as its path, and its markup with an article that changes its parent after the whole text of every fifth."""
    d, words = F.col("doc_id"), F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(d % 4 == 0, F.col("source")).alias("section_heading"), F.when(d % 4 < 3, F.transform(F.split(words, "\n", -1), sha)).otherwise(F.array().cast("array<string>")).alias("chapter_path"),
        F.concat(F.lit("<div>"), words, F.when(d % 5 == 0, "<article class='changesToParent'/></div>").otherwise("</div>")).alias("markup"),
    )
    return enrich.section_context(rows).select("doc_id", "section_heading", "is_amendment")


# -- vectors and events ---------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s FROM embeddings q JOIN embeddings e ON q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, id) AS rank FROM p)
SELECT query_id, id, rank, round(s, 6) AS similarity FROM r WHERE rank <= 10
""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = embed.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)
    return found.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("similarity", 6).alias("similarity"))


def _vector_index(spark: SparkSession, sf_dir: str) -> tuple[vector_index.VectorIndex, DataFrame, DataFrame]:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_index.VectorIndex.build(vectors, store.scratch_path(spark, "vectors"), 64), vectors, vectors.where("vec_id % 100 = 0")


@query(ORACLE_SQL["cosine_topk"])
def vector_index_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact way through the index: all cells probed."""
    index, _, queries = _vector_index(spark, sf_dir)
    found = index.search(queries, 10, len(index.centres()))
    return found.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("similarity", 6).alias("similarity"))


@query(None)
def vector_index_probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many cells as give a recall of 0.95 on a sample of the queries."""
    index, _, queries = _vector_index(spark, sf_dir)
    return index.search(queries, 10, index.probes_for(queries, 10, 0.95))


@query("SELECT user_id, ts, event_type AS status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.latest_status(table(spark, sf_dir, "events"))


@query("""
WITH last AS (SELECT user_id::VARCHAR AS doc_id, event_type AS hash, event_type = 'error' AS gone, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, (event_type = 'error') DESC, event_type DESC) AS n FROM events)
SELECT doc_id, hash FROM last WHERE n = 1 AND NOT gone
""")
def change_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as documents and their events as what the manifest says of them, through the stateful stream."""
    source = table(spark, sf_dir, "events")
    root = store.scratch_path(spark, "changes")
    kind = F.col("event_type")
    # a stream reads folders: the table is copied, so that it may be a file or a folder in any file system
    source.select(F.col("user_id").cast("string").alias("doc_id"), F.when(kind == "error", "removed").otherwise(kind).alias("status"), kind.alias("hash"), F.col("ts").cast("timestamp").alias("at")).write.parquet(f"{root}/events")
    given = spark.readStream.schema(changes.EVENT).option("maxFilesPerTrigger", 8).parquet(f"{root}/events")
    changes.write_changes(changes.changes(given, late=None), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return changes.after_changes(changes.read_changes(spark, f"{root}/out"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.windowed_counts(table(spark, sf_dir, "events"))
