"""Secret scan with multipart credential linking.

Strong spans are reported by themselves, leftmost and non-overlapping per kind:

* ``assign``: a keyword, an assignment and a value of 12 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 18 or more characters;
* ``hex``: small hexadecimal digits, 16 or more characters.

A credential is often spread over parts that say little alone. Weak parts are
``identifier`` (mail address, or a user or client id assignment), ``secret``
(an assigned value of 6 to 11 characters, or a run of 32 or more base-64
characters) and ``endpoint`` (a URL). A weak part is reported only if a
complementary part - a secret for an identifier or endpoint, an identifier or
endpoint for a secret - co-occurs in its scope, i.e. at most ``SCOPE`` code
points lie between the two in the same document; strong spans count as parts too
(``access`` as identifier, ``assign`` and ``hex`` as secrets). Scopes meet in
an interval join on bins of ``SCOPE`` code points, each part in all bins that it
touches, so a document with many parts costs their bins times the few parts
that fit in three bins.

All of it is DataFrame expressions: positions come from the lengths of the
pieces between matches. The text is read once; only spans are shuffled.

Offsets are code points, ends exclusive. Defined cases: null text is empty and
has no spans; equal spans of different kinds are all reported; rows repeated
with one ``doc_id`` and text give the same result each; a null ``doc_id`` is a
value like any other; other columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, final, scratch

SCOPE = 200
RUN = 256
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)passw|secret|token|api_?key"
# maximal runs: the same matches as "+" followed by a length test, found without the short ones
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
IDENTIFIER = (
    r"""(?i)(?:user(?:_?name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
    r"""|[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"""
)
IDENTIFIER_HINT = r"(?i)@|user|login|account|client_?id"
LONG = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""(?i)(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+"""

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
SPAN = "array<struct<start:int,rank:int,end:int>>"


HIT = "array<struct<start:int,rank:int,end:int,hit:string>>"


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _placed(pairs: Column, rank: int) -> Column:
    """Matches with their places from (gap before, match) pairs. Places are running
    sums; a list that grows match by match is copied at each, so it only ever grows
    over ``RUN`` matches, and the runs are moved by the sums of those before."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(HIT).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def moved(spans: Column, by: Column) -> Column:
        shift = lambda s: F.struct((s["start"] + by).alias("start"), s["rank"].alias("rank"), (s["end"] + by).alias("end"), s["hit"].alias("hit"))
        return F.transform(spans, shift)

    def joined(runs: Column) -> Column:
        ends = F.aggregate(runs, F.array(F.lit(0)), lambda acc, run: F.concat(acc, F.array(F.element_at(acc, -1) + run["at"])))
        return F.flatten(F.zip_with(runs, F.slice(ends, 1, F.size(runs)), lambda run, by: moved(run["out"], by)))

    def runs(p: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / RUN).cast("int"))
        return _once(F.transform(numbers, lambda k: F.aggregate(F.slice(p, k * RUN + 1, RUN), empty, step)), joined)

    return _once(pairs, lambda p: F.when(F.size(p) > 0, runs(p)).otherwise(F.array().cast(HIT)))


def _found(text: Column, pattern: str, rank: int, hint: Column) -> Column:
    """All matches as (start, rank, end, match) from the pieces between them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())
    return F.when(hint, _placed(pairs, rank)).otherwise(F.array().cast(HIT))


def _spans(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"], s["rank"], s["end"]))


def _joined(spans: Column) -> Column:
    name = lambda s: F.get(F.array(*[F.lit(k) for k in KINDS]), s["rank"])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat(name(s), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ","
    )


def _value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2))


def part_table(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: key columns, ``strong`` spans and ``weak`` spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        "doc_id",
        F.xxhash64(text).alias("th"),
        _found(text, ASSIGN, 0, text.rlike(ASSIGN_HINT)).alias("assign"),
        _found(text, ACCESS, 1, text.contains("AKIA")).alias("access"),
        _found(text, HEX, 2, text.rlike(HEX)).alias("hex"),
        _found(text, IDENTIFIER, 3, text.rlike(IDENTIFIER_HINT)).alias("identifier"),
        _found(text, LONG, 4, text.rlike(LONG)).alias("long"),
        _found(text, ENDPOINT, 5, text.contains("://")).alias("endpoint"),
    )
    strong = F.concat(_spans(F.filter("assign", lambda s: _value(s["hit"]) >= 12)), _spans(F.col("access")), _spans(F.col("hex")))
    short = F.transform(
        F.filter("assign", lambda s: _value(s["hit"]).between(6, 11)), lambda s: F.struct(s["start"], F.lit(4).alias("rank"), s["end"])
    )
    weak = F.concat(_spans(F.col("identifier")), short, _spans(F.col("long")), _spans(F.col("endpoint")))
    return found.select("doc_id", "th", strong.cast(SPAN).alias("strong"), weak.cast(SPAN).alias("weak"))


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, th, linked``: the weak spans with a complementary part in scope."""
    every = parts.where(F.size("weak") > 0).select("doc_id", "th", F.explode(F.concat("strong", "weak")).alias("s")).distinct()
    every = every.select("doc_id", "th", F.col("s.start").alias("start"), F.col("s.rank").alias("rank"), F.col("s.end").alias("end"))
    every = every.withColumn("secret", F.col("rank").isin(0, 2, 4))
    lo, hi = F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)
    near = every.where("rank >= 3").withColumn("bin", F.explode(F.sequence(lo - 1, hi + 1)))
    other = every.withColumn("bin", F.explode(F.sequence(lo, hi)))
    other = other.select(*[F.col(c).alias(f"o_{c}") for c in ("doc_id", "th", "start", "end", "secret", "bin")])
    same = F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("th") == F.col("o_th")) & (F.col("bin") == F.col("o_bin"))
    gap = F.greatest("start", "o_start") - F.least("end", "o_end")  # negative where they overlap
    in_scope = (F.col("secret") != F.col("o_secret")) & (gap <= scope)
    kept = near.join(other, same & in_scope, "left_semi")
    return kept.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "rank", "end")).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked`` per row."""
    with scratch(docs.sparkSession):
        parts = cut(part_table(docs.select("doc_id", "text")))
        linked = linked_parts(parts, scope).withColumnsRenamed({"doc_id": "l_doc_id", "th": "l_th"})
        out = parts.join(linked, F.col("doc_id").eqNullSafe(F.col("l_doc_id")) & (F.col("th") == F.col("l_th")), "left")
        extra = F.coalesce(F.col("linked").cast(SPAN), F.array().cast(SPAN))
        count = lambda rank: F.size(F.filter("strong", lambda s: s["rank"] == rank)).cast("long")
        return final(
            out.select(
                "doc_id",
                count(0).alias("n_assign"),
                count(1).alias("n_access"),
                count(2).alias("n_hex"),
                F.sha2(_joined(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
                _joined(F.concat(F.col("strong"), extra)).alias("spans"),
                F.size(extra).cast("long").alias("n_linked"),
            )
        )
