"""Catalogue rows of the whole document path: markup from ``documents``, parsed, cut, chunked, enriched and stored.

A document's text becomes units of ``UNIT`` tokens. Every third document has them in articles with
numbered values (tier 1), in sections (tier 2), or right below its main element (tier 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions import enrich, text
from .operators import embed
from .operators.chunking import Limits, chunk_rows, chunk_units, unit_pieces
from .plans import pipeline
from .queries import merge_ctes, query, sha, table
from .sources import store
from .sources.legal_xml import parse_documents
from .sources.pull_xml import parse_needed

UNIT, IN_ARTICLE, IN_SECTION = 40, 4, 6
LIMITS = Limits(target=120, maximum=500, minimum=60, overlap_ratio=0.15)
_SPACES, _WORD = r"[\x00-\x20\x7f-\xa0\p{Z}]+", r"[^\x00-\x20\x7f-\xa0\p{Z}]"


def _s(c: Column) -> Column:
    return c.cast("string")


def _plain(c: str) -> Column:
    """One blank for white space and control characters: what markup can't hold or a parser would strip."""
    return F.regexp_replace(c, _SPACES, " ")


def _escaped(c: Column) -> Column:
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(character), F.lit(entity))
    return c


def _page(body: Column, d: Column) -> Column:
    header = F.concat(F.lit('<header><dl><dd class="dokid">LOV/'), F.when(d % 2 == 0, "1999-05-17-").otherwise("none-"), _s(d), F.lit('</dd><dd class="ministry"><ul><li>A '), F.col("lang"), F.lit('</li><li> B</li></ul></dd><dd class="titleShort"> '), _escaped(F.col("source")), F.lit("</dd></dl></header>"))
    return F.concat(F.lit("<html><body>"), header, F.lit('<main class="documentBody"><h1>Document '), _s(d), F.lit("</h1>"), body, F.lit("</main></body></html>"))


def documents_as_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, document_id, content) of documents that have a word."""
    d = F.col("doc_id")

    def paragraph(u: Column, i: Column) -> Column:
        n = _s(i + 1)
        own = F.when((i + 1) % 2 == 0, F.concat(F.lit(' id="u'), n, F.lit('"'))).otherwise("")
        return F.concat(F.lit('<article class="legalP"'), own, F.lit(' data-absoluteaddress="a/'), n, F.lit('" data-x-URL="http://x/'), n, F.lit('">'), _escaped(u), F.lit('<a href="lov/1999-01-01-'), n, F.lit('"/></article>'))

    def grouped(size: int, wrap) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size("p") - 1) / size).cast("int"))
        return F.array_join(F.transform(groups, lambda g: wrap(g, F.array_join(F.slice("p", g * size + 1, F.lit(size)), ""))), "")

    articles = grouped(IN_ARTICLE, lambda g, x: F.concat(F.lit('<article class="legalArticle"><span class="legalArticleValue">§ '), _s(g + 1), F.lit("</span>"), x, F.lit("</article>")))
    sections = grouped(IN_SECTION, lambda g, x: F.concat(F.lit('<section class="section"><h2>S '), _s(g), F.lit("</h2>"), x, F.lit("</section>")))
    body = F.when(d % 3 == 0, F.concat(F.lit('<section class="section"><h2>S 0</h2>'), articles, F.lit("</section>"))).when(d % 3 == 1, sections).otherwise(F.array_join("p", ""))
    # a condition on the units would be pushed below the split and do it twice
    units = table(spark, sf_dir, "documents").where(F.col("text").rlike(_WORD)).select("doc_id", "lang", "source", text.hard_split(_plain("text"), UNIT).alias("u"))
    paged = units.select("doc_id", "lang", "source", F.transform("u", paragraph).alias("p")).select("doc_id", "lang", "source", "p", body.alias("body"))
    return paged.select("doc_id", F.concat(F.lit("d"), _s(d)).alias("document_id"), _page(F.col("body"), d).alias("content"))


_TOKENS = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\s\p{{L}}\p{{N}}]')"
_PLAIN = f"regexp_replace(text, '{_SPACES}', ' ', 'g')"
_XML_UNITS = f"""tk AS (SELECT doc_id AS doc, {_TOKENS.format(_PLAIN)} AS ts FROM documents),
xu AS (SELECT doc, (i // {UNIT} + 1)::BIGINT AS pos, array_to_string(ts[i + 1 : i + {UNIT}], ' ') AS unit, len(ts[i + 1 : i + {UNIT}])::BIGINT AS t FROM (SELECT doc, ts, unnest(range(0, len(ts), {UNIT})) AS i FROM tk))"""


@query(f"""
WITH {_XML_UNITS}, sized AS (SELECT *, count(*) OVER (PARTITION BY doc) AS n FROM xu),
rows AS (
  SELECT doc, 1 AS tier, NULL::BIGINT AS section, pos - 1 AS seq, (pos - 1) % {IN_ARTICLE} + 1 AS ledd_number, '§ ' || ((pos - 1) // {IN_ARTICLE} + 1) AS paragraph_ref, 'S 0' AS heading, 'S 0' AS path, pos, unit FROM sized WHERE doc % 3 = 0
  UNION ALL SELECT doc, 2, 0, n + pos - 1, NULL, NULL, 'S 0', '', pos, unit FROM sized WHERE doc % 3 = 0
  UNION ALL SELECT doc, 2, (pos - 1) // {IN_SECTION}, pos - 1, NULL, NULL, 'S ' || ((pos - 1) // {IN_SECTION}), '', pos, unit FROM sized WHERE doc % 3 = 1
  UNION ALL SELECT doc, 3, NULL, pos - 1, pos, NULL, NULL, NULL, pos, unit FROM sized WHERE doc % 3 = 2)
SELECT 'd' || doc AS document_id, tier, section, seq, CASE WHEN pos % 2 = 0 THEN 'u' || pos END AS unit_id, ledd_number, paragraph_ref, heading AS section_heading, path AS chapter_path, 'Document ' || doc AS document_title,
  'a/' || pos AS address, 'http://x/' || pos AS url, 'lov/1999-01-01-' || pos AS cross_refs, sha256(unit) AS text_sha FROM rows
""")
def xml_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = parse_documents(documents_as_xml(spark, sf_dir))
    longs = [F.col(c).cast("long").alias(c) for c in ("section", "seq", "ledd_number")]
    joined = [F.array_join(c, "|").alias(c) for c in ("chapter_path", "cross_refs")]
    return units.where("error is null").select("document_id", "tier", *longs, "unit_id", "paragraph_ref", "section_heading", "document_title", "address", "url", *joined, sha(F.col("text")).alias("text_sha"))


def _chunks_sql(compat: bool = False) -> str:
    # units of tiers 1 and 3, and the groups of tier 2, as what is merged
    base = f"""{_XML_UNITS},
r2 AS (
  SELECT DISTINCT doc, (pos - 1) // {IN_SECTION} AS sec, ((pos - 1) // {IN_SECTION}) * {IN_SECTION} AS pos, 0::BIGINT AS total, 0::BIGINT AS n, 0::BIGINT AS gid FROM xu WHERE doc % 3 = 1
  UNION ALL
  SELECT r2.doc, r2.sec, u.pos, CASE WHEN r2.n > 0 AND r2.total + u.t > {LIMITS.target} THEN u.t ELSE r2.total + u.t END,
         CASE WHEN r2.n > 0 AND r2.total + u.t > {LIMITS.target} THEN 1 ELSE r2.n + 1 END, r2.gid + (r2.n > 0 AND r2.total + u.t > {LIMITS.target})::BIGINT
  FROM r2 JOIN xu u ON u.doc = r2.doc AND u.pos = r2.pos + 1 AND (u.pos - 1) // {IN_SECTION} = r2.sec),
g2 AS (SELECT doc, sec, gid, min(pos) AS first, string_agg(unit, chr(10) || chr(10) ORDER BY pos) AS unit, sum(t)::BIGINT AS t, count(*) AS refs FROM r2 JOIN xu USING (doc, pos) WHERE n > 0 GROUP BY ALL),
units AS (
  SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY sec, gid) AS pos, unit, t, first, 'S ' || sec AS heading, refs FROM g2
  UNION ALL SELECT doc, pos, unit, t, pos, CASE WHEN doc % 3 = 0 THEN 'S 0' END, 1 FROM xu WHERE doc % 3 <> 1)"""
    heading = "CASE WHEN doc % 3 = 1 THEN 'Document ' || doc ELSE coalesce(first(heading ORDER BY pos), 'Document ' || doc) END" if compat else "coalesce(first(heading ORDER BY pos), 'Document ' || doc)"
    refs = "1" if compat else "sum(refs)"
    return f"""{merge_ctes(base, LIMITS.minimum, LIMITS.maximum)}
SELECT 'd' || doc || '_chunk_' || gid AS chunk_id, 'd' || doc AS document_id, 'set' || (doc % 7) AS dataset_name, sum(t)::BIGINT AS token_count, {heading} AS section_heading,
  'http://x/' || min(first) AS absolute_address, 'h' || doc AS source_hash, {refs}::BIGINT AS n_refs, sha256(string_agg(unit, chr(10) || chr(10) ORDER BY pos)) AS content_sha
FROM placed JOIN units USING (doc, pos) GROUP BY doc, gid"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    name = F.concat(F.lit("d"), _s(d))
    status = F.when(d % 10 == 0, "removed").when(d % 10 < 3, "modified").when(d % 10 < 6, "added").otherwise("unchanged")
    return table(spark, sf_dir, "documents").select(
        d.cast("long").alias("position"), name.alias("doc_id"), F.concat(F.lit("set"), _s(d % 7)).alias("dataset"), F.concat(name, F.lit(".xml")).alias("relative_path"),
        F.concat(F.lit("extracted/"), name, F.lit(".xml")).alias("path"), status.alias("status"), F.concat(F.lit("h"), _s(d)).alias("hash"),
    )


_CHUNK_COLUMNS = ("chunk_id", "document_id", "dataset_name", "section_heading", "absolute_address", "source_hash")


def _shown(chunks: DataFrame) -> DataFrame:
    return chunks.select(*_CHUNK_COLUMNS, F.col("token_count").cast("long").alias("token_count"), F.size("cross_refs").cast("long").alias("n_refs"), sha(F.col("content")).alias("content_sha"))


@query(_chunks_sql())
def xml_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = parse_needed(documents_as_xml(spark, sf_dir), LIMITS.maximum)
    return _shown(chunk_rows(chunk_units(units, LIMITS), _manifest(spark, sf_dir)))


@query(_chunks_sql(compat=True))
def xml_chunks_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = parse_needed(documents_as_xml(spark, sf_dir), LIMITS.maximum)
    return _shown(chunk_rows(chunk_units(units, LIMITS, compat=True), _manifest(spark, sf_dir), compat=True))


_LARGE = 50
_PARTS = rf"list_filter(list_transform(string_split(regexp_replace({_PLAIN}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


@query(f"""
WITH RECURSIVE x AS (SELECT doc_id AS doc, trim({_PLAIN}) AS whole, {_PARTS} AS ss, len({_TOKENS.format(_PLAIN)})::BIGINT AS t FROM documents WHERE trim({_PLAIN}) <> ''),
p AS (SELECT doc, ss, len(ss)::BIGINT AS n, list_transform(ss, lambda s: len({_TOKENS.format("s")})::BIGINT) AS ts, greatest(1, (len(ss) * 10) // 50)::BIGINT AS back FROM x WHERE t > {_LARGE} AND doc % 3 = 0),
q AS (SELECT *, list_prepend(0::BIGINT, list_transform(range(1, n + 1), lambda k: list_sum(ts[1:k])::BIGINT)) AS sums FROM p),
r AS (
  SELECT doc, 0::BIGINT AS i, len(list_filter(sums, lambda s: s <= {_LARGE}))::BIGINT - 1 AS j, 0::BIGINT AS step FROM q WHERE n > 0
  UNION ALL
  SELECT doc, i, len(list_filter(sums, lambda s: s <= sums[i + 1] + {_LARGE}))::BIGINT - 1, step
  FROM (SELECT r.doc, greatest(r.i + 1, r.j - q.back) AS i, q.sums, q.n, r.step + 1 AS step FROM r JOIN q USING (doc)) WHERE i < n),
windows AS (SELECT doc, 1 AS tier, '§ 1-ledd1-' || row_number() OVER (PARTITION BY doc ORDER BY i) AS chunk_id, (sums[j + 1] - sums[i + 1])::BIGINT AS tokens, array_to_string(ss[i + 1 : j], ' ') AS s FROM r JOIN q USING (doc) WHERE j > i),
items AS (SELECT doc, generate_subscripts(ss, 1) AS n, unnest(ss) AS s FROM x WHERE t + CASE WHEN doc % 3 = 1 THEN len(ss) ELSE 0 END > {_LARGE} AND doc % 3 > 0),
counted AS (SELECT *, len({_TOKENS.format("s")})::BIGINT AS tokens FROM items),
cut AS (SELECT doc, 1 AS tier, '§ 1-ledd1-part' || n AS chunk_id, tokens, s FROM (SELECT doc, n, 'i' || n || ' ' || s AS s, tokens + 1 AS tokens FROM counted WHERE doc % 3 = 1) WHERE tokens <= {_LARGE}
  UNION ALL SELECT doc, 3, 'ledd-1-' || row_number() OVER (PARTITION BY doc ORDER BY n), tokens, s FROM counted WHERE doc % 3 = 2 AND tokens <= {_LARGE})
SELECT 'd' || doc AS document_id, tier, chunk_id, tokens, sha256(s) AS text_sha FROM (
  SELECT * FROM windows UNION ALL SELECT * FROM cut UNION ALL SELECT doc, CASE WHEN doc % 3 = 2 THEN 3 ELSE 1 END, CASE WHEN doc % 3 = 2 THEN 'ledd-1' ELSE '§ 1-ledd1' END, t, whole FROM x WHERE t <= {_LARGE} AND doc % 3 <> 1
  UNION ALL SELECT doc, 1, '§ 1-ledd1', t + len(ss), array_to_string(list_transform(ss, lambda s, i: 'i' || i || ' ' || s), ' ') FROM x WHERE t + len(ss) <= {_LARGE} AND doc % 3 = 1)
""")
def xml_large_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one unit: cut to sentence windows (tier 1), to list items of one sentence each, or to sentences (tier 3)."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.trim(_plain("text")).alias("t")).where("t <> ''")
    one_each = F.transform(text.sentences(F.col("t")), lambda s, i: F.concat(F.lit("<ol>"), F.lit('<li data-name="i'), _s(i + 1), F.lit('">'), _escaped(s), F.lit("</li></ol>")))
    inner = F.when(d % 3 == 1, F.array_join(one_each, "")).otherwise(_escaped(F.col("t")))
    unit = F.concat(F.lit('<article class="legalP">'), inner, F.lit("</article>"))
    body = F.when(d % 3 == 2, unit).otherwise(F.concat(F.lit('<article class="legalArticle"><span class="legalArticleValue">§ 1</span>'), unit, F.lit("</article>")))
    units = parse_documents(docs.select(F.concat(F.lit("d"), _s(d)).alias("document_id"), _page(body, d).alias("content")))
    pieces = unit_pieces(units, Limits(target=_LARGE, maximum=_LARGE, minimum=20, overlap_ratio=0.2))
    return pieces.select("document_id", "tier", "chunk_id", "tokens", sha(F.col("text")).alias("text_sha"))


@query(f"""WITH chunks AS ({_chunks_sql()}), files AS (SELECT doc_id, 'd' || doc_id AS document_id, len({_TOKENS.format(_PLAIN)}) > 0 AS there FROM documents WHERE doc_id % 10 > 0)
SELECT f.document_id, CASE WHEN f.there THEN 'processed' ELSE 'failed' END AS status, count(c.chunk_id) AS n_chunks, coalesce(sum(c.token_count), 0)::BIGINT AS n_tokens, coalesce(sum(c.n_refs), 0)::BIGINT AS n_refs
FROM files f LEFT JOIN chunks c ON c.document_id = f.document_id GROUP BY ALL""")
def process_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run without the last documents, then one over all: state and store afterwards. Documents without words have no file."""
    root = store.scratch_path(spark, "run")
    settings = Settings(data_dir=root, storage="store", embedding_dimensions=256, chunk_max_tokens=LIMITS.maximum, chunk_target_tokens=LIMITS.target, chunk_min_tokens=LIMITS.minimum)
    files = documents_as_xml(spark, sf_dir).select(F.concat(F.lit("extracted/"), "document_id", F.lit(".xml")).alias("path"), "content")
    files.write.parquet(f"{root}/files")
    files, manifest = spark.read.parquet(f"{root}/files"), _manifest(spark, sf_dir)
    provider = embed.HashEmbedding(256)
    pipeline.process(spark, settings, provider, corpus=(manifest.withColumn("status", F.lit("added")).where("position % 4 <> 0 or position % 10 = 0"), files))
    pipeline.process(spark, settings, provider, corpus=(manifest, files))
    chunks = store.open_store(spark, root, "store").read().groupBy("document_id").agg(F.count("*").alias("n"), F.sum("token_count").alias("t"), F.sum(F.size("cross_refs")).alias("r"))
    state = pipeline.read_state(spark, f"{root}/state").withColumnRenamed("doc_id", "document_id")
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return state.join(chunks, "document_id", "left").select("document_id", "status", none("n").alias("n_chunks"), none("t").alias("n_tokens"), none("r").alias("n_refs"))


# -- enrichment of parsed units -----------------------------------------------------------------------------


@query(f"""
WITH {_XML_UNITS} SELECT 'd' || doc AS document_id, pos, source AS title_short, CASE WHEN doc % 2 = 0 THEN '1999-05-17' END AS document_date, 'A ' || lang || '|B' AS ministries, 'http://x/' || pos AS source_url, 'a/' || pos AS absolute_address,
  CASE WHEN doc % 3 = 0 THEN 'S 0' WHEN doc % 3 = 1 THEN 'S ' || ((pos - 1) // {IN_SECTION}) END AS section_heading, 'lov/1999-01-01-' || pos AS outgoing_refs, 1 AS reference_count, NULL::BOOLEAN AS is_amendment
FROM xu JOIN documents ON doc_id = doc
UNION ALL SELECT 'd' || doc, n + pos, source, CASE WHEN doc % 2 = 0 THEN '1999-05-17' END, 'A ' || lang || '|B', 'http://x/' || pos, 'a/' || pos, 'S 0', 'lov/1999-01-01-' || pos, 1, NULL
FROM (SELECT *, count(*) OVER (PARTITION BY doc) AS n FROM xu WHERE doc % 3 = 0) JOIN documents ON doc_id = doc
""")
def xml_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = parse_documents(documents_as_xml(spark, sf_dir), markup=True).where("error is null")
    rows = enrich.Registry().enrich(units.withColumn("chunk_id", F.concat_ws("-", "document_id", _s(F.col("seq")))))
    return rows.select("document_id", (F.col("seq") + 1).cast("long").alias("pos"), "title_short", "document_date", F.array_join("ministries", "|").alias("ministries"), "source_url", "absolute_address", "section_heading", F.array_join("outgoing_refs", " ").alias("outgoing_refs"), "reference_count", "is_amendment")


@query(r"""
WITH f AS (SELECT doc_id, list_distinct(regexp_extract_all(text, 'lov/[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]+(?:/[^"\s]+)?')) AS r FROM documents)
SELECT doc_id, array_to_string(list_sort(r), ' ') AS refs, nullif(len(r), 0)::INT AS reference_count FROM f
""")
def enrich_text_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.references(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return rows.select("doc_id", F.array_join(F.array_sort(F.coalesce("outgoing_refs", F.array().cast("array<string>"))), " ").alias("refs"), "reference_count")
