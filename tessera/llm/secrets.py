"""Secret scans in DataFrame operations only: patterns, and character Markov
models for what patterns don't know.

Base kinds, leftmost and non-overlapping per kind: ``assign`` (a secret's name, a
separator and a value of 8 characters or more), ``access`` (access key ids),
``hex`` (32 hexadecimal digits or more). A pattern's match positions come from the
lengths of the pieces that ``split`` leaves between its matches.

``markov`` spans: runs of token characters (20 or more, 8 different ones; what
base spans leave of a run is judged stretch by stretch)
whose log-likelihood ratio under two bigram models, random strings against
ordinary identifiers, exceeds ``min_ratio``. The models are trained from labelled
samples: random strings are digests in several alphabets, made by rule; ordinary
identifiers are the words of about ``sample_docs`` documents (those in a share of
the hash range of ids, without their base matches), joined the way identifiers
are. The bigram
table has a fixed size (characters squared), so it goes into the plan as a
constant.

Positions are code points, ends exclusive. Defined results: null and empty texts
have no spans; rows are judged one by one, repeated rows alike; with no documents
to train on, the ordinary model is uniform and no run is above the ratio by
chance alone. Extra columns are kept as they are; one named ``secret_spans`` is
replaced by the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import unused

# The base patterns.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

KINDS = ("assign", "access", "hex", "markov")
LEAST = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Characters of the Markov models, one state each.
STATES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Log of the odds against a token being a secret, before it is read.
MIN_RATIO = 14.0
MARK = "[SECRET]"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def spans_of(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Matches of ``pattern`` as ``start, kind, end, value``; ``value`` is the
    group, matches whose group is shorter than ``least`` are left out."""
    pat = F.lit(pattern)
    zipped = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, pat, F.lit(0)),
                          F.regexp_extract_all(text, pat, F.lit(group)))

    def step(a: Column, z: Column) -> Column:
        start = a["at"] + F.length(z["0"])
        end = start + F.length(z["1"])
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                                z["2"].alias("value")))
        return F.struct(F.coalesce(end, a["at"]).alias("at"), F.when(
            F.length(z["2"]) >= least, F.concat(a["out"], span)).otherwise(a["out"]).alias("out"))

    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), _none().alias("out")), step, lambda a: a["out"])
    return F.when(F.rlike(text, pat), found).otherwise(_none())


def base_spans(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.sort_array(F.concat(spans_of(text, ASSIGN, 0, 2, 8), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)))


def _pairs(token: Column) -> Column:
    """Codes of the neighbouring characters of a token."""
    states = F.lit(STATES)

    def code(i: Column) -> Column:
        return F.call_function("locate", F.substring(token, i, F.lit(1)), states) - 1

    return F.when(F.length(token) > 1, F.transform(
        F.sequence(F.lit(1), F.length(token) - 1),
        lambda i: code(i) * len(STATES) + code(i + 1))).otherwise(F.array().cast("array<int>"))


def train(docs: DataFrame, id_col: str, text_col: str, sample_docs: int = 300,
          random_strings: int = 3000) -> list[float]:
    """Log-ratio of every bigram, random over ordinary (states squared values)."""
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 512)
    made = spark.range(random_strings).select(F.explode(F.array(
        digest, F.base64(F.unhex(digest)), F.upper(digest),
        F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", ""),
        F.translate(F.base64(F.unhex(digest)), "+/", "-_"))).alias("token"), F.lit(1).alias("random"))
    plain = F.col(text_col)
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    # a share of the hash range that holds about sample_docs documents: no task sorts or gathers texts
    place = F.abs(F.xxhash64(F.col(id_col).cast("string")) % 1_000_000_007) / 1_000_000_007.0
    sample = (docs.where(place * docs.count() < sample_docs).repartition(8)
              .select(F.regexp_extract_all(plain, F.lit("[A-Za-z0-9+/_=-]{2,}"), F.lit(0)).alias("w")))
    word = sample.select(F.explode(F.arrays_zip("w", F.slice("w", 2, 1 << 30))).alias("z")).select(
        F.col("z")["w"].alias("a"), F.coalesce(F.col("z")["1"], F.lit("id")).alias("b"))
    own = word.select(F.explode(F.array(
        F.concat_ws("_", "a", "b"), F.concat(F.lower("a"), F.initcap("b")),
        F.concat_ws("/", "a", "b"), F.upper(F.concat_ws("-", "a", "b")))).alias("token"),
        F.lit(0).alias("random"))
    counts = (made.union(own).select("random", F.explode(_pairs(F.col("token"))).alias("pair"))
              .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("c")).collect())  # two tables of fixed size
    n = len(STATES)
    seen = [[0.5] * (n * n) for _ in range(2)]
    for r in counts:
        if 0 <= r["pair"] < n * n:
            seen[r["random"]][r["pair"]] += r["c"]
    out = []
    for a in range(n):
        rows = [s[a * n:(a + 1) * n] for s in seen]
        total = [sum(r) for r in rows]
        out += [math.log(rows[1][b] / total[1]) - math.log(rows[0][b] / total[0]) for b in range(n)]
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 300,
         min_ratio: float = MIN_RATIO) -> DataFrame:
    """All columns of ``docs`` and ``secret_spans`` (``start, kind, end, value``,
    sorted; ``kind`` is an index into KINDS)."""
    ratios = train(docs, id_col, text_col, sample_docs)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    text = F.coalesce(F.col(text_col), F.lit(""))

    def random_like(token: Column) -> Column:
        varied = F.size(F.array_distinct(F.split(token, ""))) >= 8  # not a ruler such as ------
        return varied & (F.aggregate(_pairs(token), F.lit(0.0), lambda a, p: a + F.get(table, p)) > min_ratio)

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "secret_spans"]
    base, tokens = unused(docs, "base", "tokens")
    based = docs.select(*kept, base_spans(F.col(text_col)).alias(base), spans_of(text, TOKEN, 3).alias(tokens))
    based = based.withColumn(tokens, _outside(F.col(tokens), F.col(base)))
    own = F.filter(tokens, lambda t: random_like(t["value"]))
    return based.select(*kept, F.sort_array(F.concat(base, own)).alias("secret_spans"))


def _outside(tokens: Column, base: Column) -> Column:
    """The stretches of the tokens, long enough for one, outside the base spans."""
    def cut(t: Column) -> Column:
        def push(a: Column, end: Column) -> Column:
            piece = F.struct(a["at"].alias("start"), t["kind"].alias("kind"), end.alias("end"),
                             F.substring(t["value"], a["at"] - t["start"] + 1, end - a["at"]).alias("value"))
            return F.when(end - a["at"] >= LEAST, F.concat(a["out"], F.array(piece))).otherwise(a["out"])

        # the base spans come sorted by their start
        return F.aggregate(
            F.filter(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
            F.struct(t["start"].alias("at"), _none().alias("out")),
            lambda a, b: F.struct(F.greatest(a["at"], b["end"]).alias("at"), push(a, b["start"]).alias("out")),
            lambda a: push(a, t["end"]))

    return F.flatten(F.transform(tokens, cut))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch of overlapping spans replaced by a mark."""
    def step(a: Column, s: Column) -> Column:
        apart = s["start"] >= a["at"]
        new = F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(MARK)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(apart, new).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda a: F.array_join(F.concat(
        a["out"], F.array(F.substring(text, a["at"] + 1, F.length(text)))), ""))).otherwise(text)
