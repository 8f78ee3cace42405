"""PII: bootstrapped contextual extraction of emails, IP addresses, card and phone numbers, and secrets.

Native. A mention is a run of number characters, a word with "@", or a long run of letters and digits.
Patterns of fixed form find the base spans within mentions, which seed the method; for secrets, which
have no fixed form, mentions behind a seed name ("token =") do. A seed name only seeds: no mention is found but
by a pattern's score. A mention's lexical patterns are the two
words before it, and the one before or after it together with the mention's shape (runs of digits and of
letters generalised). Instances and patterns make a bipartite graph. In each round a pattern of a kind
scores the mean confidence of its distinct instances, an instance the best score of its patterns, and
instances over the threshold whose form could be of the kind join the seeds, until none joins. What
joined are identifiers that no fixed form knew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, stage

KINDS = ("email", "ip", "card", "phone")
#: What only the method finds.
SECRET = "secret"
_LOCAL, _S = "[A-Za-z0-9._%+-]", r"\x20\x09-\x0D"
# Fixed forms. Possessive groups keep Java's matcher iterative on long texts, and the first alternative
# (at the end of the last match, or not within a run) keeps it linear; neither changes what is matched.
FORMS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Mentions: the form of the whole run, a cheap test that a text has one, and the kinds whose matches lie within.
#: A match of a fixed form never leaves its run, so forms are looked for in runs, not in texts.
RUNS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "number": (r"[+(0-9][0-9+().\x20-]*+", "[0-9]", ("ip", "card", "phone")),
    "mail": (rf"(?<![^{_S}])[^{_S}@]*+@[^{_S}]*+", "@", ("email",)),
    "long": (r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]{20,}+", "[0-9A-Za-z+/_-]{20}", ()),
}
#: Names behind which a long run is a seed of the secrets, in the one or two words before it.
SEED_NAMES = "token|secret|passw|api.?key|credential"


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.char_length(F.ltrim(p, F.lit("0"))) < 4) & F.forall(F.split(match, r"\."), lambda p: F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
    digits = _digits(match)
    if kind == "phone":
        return F.char_length(digits).between(8, 15)
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)).otherwise(d.try_cast("int")))
    luhn = F.aggregate(F.filter(doubled, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0
    return F.when(F.char_length(digits).between(16, 19), luhn).otherwise(F.lit(False))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _placed(rows: DataFrame, by: list[str], text: Column, form: str, *keep: str) -> DataFrame:
    """``rows`` by match of ``form`` in ``text``: by, keep, i, at (code points before it), match, gap, next (the text on either side).

    Spark's matchers give no positions: a match starts after all gaps and matches before it. The sum is a
    window over the matches of one document, which spills. Rows that repeat ``by`` are taken once.
    """
    found = rows.select(*by, *keep, text.alias("_text")).select(*by, *keep, "_text", F.regexp_extract_all("_text", F.lit(form), F.lit(0)).alias("found")).where(F.size("found") > 0)
    pieces = found.select(*by, *keep, "found", F.split("_text", form, -1).alias("gaps"))
    zipped = F.arrays_zip("found", F.slice("gaps", F.lit(1), F.size("found")).alias("gap"), F.slice("gaps", F.lit(2), F.size("found")).alias("next"))
    rows = pieces.select(*by, *keep, F.posexplode(zipped).alias("i", "m")).select(*by, *keep, "i", F.col("m.found").alias("match"), F.col("m.gap").alias("gap"), F.col("m.next").alias("next"))
    return rows.withColumn("length", F.char_length("gap") + F.char_length("match"))


def _starts(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` of ``_placed`` with ``at``, once for each match."""
    upto = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return rows.dropDuplicates([*by, "i"]).withColumn("at", F.sum("length").over(upto) - F.char_length("match")).drop("length")


def _around(rows: DataFrame) -> DataFrame:
    """Gaps as context: ``ahead`` (what is glued on before), w1 and w2 (the last words before that), ``after`` (the next word).

    Words are read from the gap's end by reversing it, so that a gap of any length is one linear step.
    """
    rows = rows.withColumn("next", F.when(F.endswith("match", F.lit(" ")), F.concat(F.lit(" "), "next")).otherwise(F.col("next")))
    back = F.reverse("gap")
    word = lambda n: F.reverse(F.regexp_extract(back, rf"^[^{_S}]*+(?:[{_S}]++([^{_S}]++))?+(?:[{_S}]++([^{_S}]++))?+", n))
    rows = rows.withColumns({"ahead": F.reverse(F.regexp_extract(back, rf"^[^{_S}]*+", 0)), "w1": word(1), "w2": word(2), "after": F.regexp_extract("next", rf"^[^{_S}]*+[{_S}]++([^{_S}]++)", 1), "tail": F.regexp_extract("next", rf"^[^{_S}]*+", 0)})
    return rows.drop("gap", "next")


def _mentions(base: DataFrame) -> DataFrame:
    """(doc_id, body, run, i, at, match, ahead, w1, w2, after, tail) of all runs."""
    out = None
    for run, (form, test, _) in RUNS.items():
        some = base.where(F.col("text").contains(test) if len(test) == 1 else F.col("text").rlike(test))
        rows = _around(_placed(some, ["doc_id", "body"], F.col("text"), form)).withColumn("run", F.lit(run))
        out = rows if out is None else out.unionByName(rows)
    return _starts(out, ["doc_id", "body", "run"])


def _base_matches(mentions: DataFrame) -> DataFrame:
    """(doc_id, body, run, i, kind, start, end, first, last, instance): matches of the fixed forms that pass their kind's test.

    ``first`` and ``last`` say that nothing but marks stands between the match and that end of its run.
    ``instance`` is the match, of cards and phones its digits.
    """
    out, own = None, ["doc_id", "body", "run", "run_i", "run_at"]
    rows = mentions.select("doc_id", "body", "run", F.col("i").alias("run_i"), F.col("at").alias("run_at"), "match")
    for run, (_, _, kinds) in RUNS.items():
        for kind in kinds:
            found = _placed(rows.where(F.col("run") == run), own, F.col("match"), FORMS[kind]).withColumns({"kind": F.lit(kind), "lead": ~F.col("gap").rlike("[0-9A-Za-z]"), "trail": ~F.col("next").rlike("[0-9A-Za-z]")}).drop("gap", "next")
            found = found.withColumn("ok", _valid(kind, F.col("match")))
            out = found if out is None else out.unionByName(found)
    out = _starts(out, [*own, "kind"]).where("ok")
    start = F.col("run_at") + F.col("at")
    instance = F.when(F.col("kind").isin("card", "phone"), _digits(F.col("match"))).otherwise(F.lower("match"))
    return out.select("doc_id", "body", "run", F.col("run_i").alias("i"), "kind", start.alias("start"), (start + F.char_length("match")).alias("end"), (F.col("lead") & (F.col("i") == 0)).alias("first"), F.col("trail").alias("last"), instance.alias("instance"))


def _candidates(mentions: DataFrame) -> DataFrame:
    """Mentions without a base span, as they could be found: the run without marks at its ends, and the kinds that it could be."""
    loose = mentions.where("not (ahead rlike '[0-9A-Za-z]$') and not (run <> 'mail' and tail rlike '^[0-9A-Za-z@]')")
    core = F.regexp_extract("match", r"[0-9A-Za-z+(].*?(?=[^0-9A-Za-z)]*+$)", 0)
    lead = F.char_length(F.regexp_extract("match", "^[^0-9A-Za-z+(]*+", 0))
    rows = loose.withColumns({"core": core, "start": F.col("at") + lead}).where("core <> ''").withColumn("end", F.col("start") + F.char_length("core"))
    digits = F.char_length(_digits(F.col("core")))
    could = {
        "email": (F.col("run") == "mail") & F.col("core").rlike("^[^@]+@[^@]+$"),
        "ip": F.col("core").rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){2,3}$"),
        "card": F.col("core").rlike(r"^[0-9]+(?:[\x20-][0-9]+)*+$") & digits.between(12, 19),
        "phone": F.col("core").rlike(r"^[+(]*+[0-9][0-9().\x20-]*+$") & digits.between(7, 15) & ~F.col("core").rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
        SECRET: (F.col("run") == "long") & F.col("core").rlike("[0-9]") & F.col("core").rlike("[A-Za-z]"),
    }
    instance = F.when(F.col("run") == "number", F.when(could["ip"], F.col("core")).otherwise(_digits(F.col("core")))).when(F.col("run") == "mail", F.lower("core")).otherwise(F.col("core"))
    kinds = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in could.items()]), lambda k: k.isNotNull())
    return rows.withColumns({"instance": instance, "kinds": kinds})


def _patterns(before: Column, behind: Column) -> Column:
    """The lexical patterns of a mention, where ``before`` and ``behind`` say that its words stand next to it."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("surface", "[0-9]++", "9"), "[a-z]++", "a"), "[A-Z]++", "A")
    glued = F.col("ahead").rlike("[0-9A-Za-z]")  # name="...: what is glued on is the word before
    w1, w2 = F.lower(F.when(glued, F.col("ahead")).otherwise(F.col("w1"))), F.lower(F.when(glued, F.col("w1")).otherwise(F.col("w2")))
    made = [
        F.when(before & (w1 != ""), F.concat_ws("|", F.lit("2"), w2, w1)),
        F.when(before & (w1 != ""), F.concat_ws("|", F.lit("L"), w1, shape)),
        F.when(behind & (F.col("after") != ""), F.concat_ws("|", F.lit("R"), shape, F.lower("after"))),
    ]
    return F.filter(F.array(*made), lambda p: p.isNotNull())


def find_personal_data(docs: DataFrame, *, threshold: float = 0.9, min_seeds: int = 5, max_rounds: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, kind, start, end, base): one row per span, ``base`` false for those that the method adds.

    Positions are code points, end exclusive. An added span is a mention without marks at its ends. A
    pattern counts from ``min_seeds`` distinct seeds of a kind on and an instance joins a kind at
    ``threshold``. Rounds go on until no instance joins; seeds never leave, so that ends; ``max_rounds`` rounds without
an end are an error.

    Scale: a text is tested for each sort of mention and cut at mentions only; what leaves a task is a row
    per mention, which the window over a document's mentions places. A base span is found within its
    mention, so spans and mentions are never joined by position. Mentions, edges and seeds are staged, and
    a round joins and sums rows of the graph, partially first, so a context that a third of all mentions
    share is one row per task; scores join staged rows on the pattern, whose hot keys Spark splits.

    Edge cases: null and empty texts have no spans. Repeated rows share theirs, rows that repeat a doc_id
    with another text have their own. A row without doc_id has its spans under a null doc_id. A very long
    text is one group of mentions, in order, which spills; contexts are read whole, however far back the
    words lie. Other columns are ignored; an empty table gives an empty result.
    """
    base = keyed(docs, id_col, text_col)
    mentions = stage(_mentions(base), "mentions")
    fixed = stage(_base_matches(mentions), "spans")
    own = ["doc_id", "body", "run", "i"]
    match = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.body") == F.col(f"{b}.body")) & (F.col(f"{a}.run") == F.col(f"{b}.run")) & (F.col(f"{a}.i") == F.col(f"{b}.i"))

    context = ["ahead", "w1", "w2", "after"]
    seeded = mentions.alias("m").join(fixed.alias("s"), match("m", "s")).select(*[F.col(f"m.{c}") for c in context], F.substring(F.col("m.match"), (F.col("s.start") - F.col("m.at") + 1).cast("int"), (F.col("s.end") - F.col("s.start")).cast("int")).alias("surface"), "s.kind", "s.instance", "s.first", "s.last")
    known = seeded.select(F.explode(_patterns(F.col("first"), F.col("last"))).alias("pattern"), "instance", "kind")
    loose = _candidates(mentions.alias("m").join(fixed.alias("s"), match("m", "s"), "left_anti"))
    loose = loose.withColumn("surface", F.col("core"))
    names = F.concat_ws(" ", "w2", "w1", "ahead").rlike(f"(?i)(?:{SEED_NAMES})") & F.array_contains("kinds", SECRET)
    loose = stage(loose.select(*own, "start", "end", "instance", "kinds", names.alias("named"), _patterns(F.lit(True), F.lit(True)).alias("patterns")), "loose")

    known = stage(known.unionByName(loose.where("named").select(F.explode("patterns").alias("pattern"), "instance", F.lit(SECRET).alias("kind"))).distinct(), "known")
    around = loose.select(F.explode("patterns").alias("pattern"), "instance", "kinds")
    # distinct instances of each pattern, seeds or not: the denominator of its score
    degree = stage(known.select("pattern", "instance").union(around.select("pattern", "instance")).distinct().groupBy("pattern").agg(F.count("*").alias("degree")), "degree")
    open_edges = stage(around.select("pattern", "instance", F.explode("kinds").alias("kind")).distinct(), "edges")
    joined, count = open_edges.limit(0).select("instance", "kind", F.lit(0.0).alias("confidence")), 0
    for step in range(max_rounds + 1):
        if step == max_rounds:
            raise RuntimeError(f"instances still joined after {max_rounds} rounds: raise max_rounds")
        seeds = known.withColumn("confidence", F.lit(1.0)).unionByName(open_edges.join(joined, ["instance", "kind"]).select("pattern", "instance", "kind", "confidence"))
        seeds = seeds.groupBy("pattern", "instance", "kind").agg(F.max("confidence").alias("confidence"))
        scores = seeds.groupBy("pattern", "kind").agg(F.sum("confidence").alias("sum"), F.count("*").alias("seeds")).where(F.col("seeds") >= min_seeds)
        scores = scores.join(degree, "pattern").select("pattern", "kind", (F.col("sum") / F.col("degree")).alias("score")).where(F.col("score") >= threshold)
        joined = stage(open_edges.join(scores, ["pattern", "kind"]).groupBy("instance", "kind").agg(F.max("score").alias("confidence")), "joined")
        now = joined.count()
        if now == count:
            break
        count = now
    columns = ["doc_id", "body", "kind", "start", "end"]
    added = loose.select("doc_id", "body", F.explode("kinds").alias("kind"), "start", "end", "instance").join(joined.select("instance", "kind"), ["instance", "kind"], "left_semi")
    return fixed.select(*columns, F.lit(True).alias("base")).unionByName(added.select(*columns).distinct().withColumn("base", F.lit(False)))


def spans_by_document(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, a count of base spans by kind, ``base_spans``, ``spans``, ``n_secret``, ``secret_spans``, ``n_found``.

    Spans are kind:start:end by kind as ``KINDS`` lists them and secrets last, then start, comma-joined. ``spans`` has
    all, ``secret_spans`` the secrets alone; ``n_found`` counts all. Spans are gathered by document.
    """
    order = F.array_position(F.array(*map(F.lit, (*KINDS, SECRET))), F.col("kind"))
    item = F.struct(order.alias("o"), F.col("start"), F.col("end"), F.col("kind"), F.col("base"))
    lists = spans.groupBy(F.col("doc_id").alias("s_id"), F.col("body").alias("s_body")).agg(F.array_sort(F.collect_list(item)).alias("found"))
    lists = lists.select("s_id", "s_body", F.size("found").alias("n_found"), F.col("found").alias("all"), F.filter("found", lambda s: s["kind"] == SECRET).alias("secrets"), F.filter("found", lambda s: s["base"]).alias("own"))
    text = lambda c: F.coalesce(F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))
    count = lambda kind: F.coalesce(F.size(F.filter("own", lambda s: s["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")
    some = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    return (
        keyed(docs, id_col, text_col)
        .select("doc_id", "body")
        .join(lists, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("body") == F.col("s_body")), "left")
        .select("doc_id", *[count(k) for k in KINDS], text("own").alias("base_spans"), text("all").alias("spans"), some(F.size("secrets"), "n_secret"), text("secrets").alias("secret_spans"), some(F.col("n_found"), "n_found"))
    )
