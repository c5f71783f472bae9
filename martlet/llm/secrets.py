"""Operator 10: secret scan with multipart credential linking (DataFrame functions only).

Strong spans (assignments with a long value, access keys, long hex runs) are reported
wherever they stand.  Weak parts are spans that mean little alone: an assignment with a
short value or to a name that is only like a secret's (secret_access_key, private_key, pwd),
a bare mixed string of 40 code points or more, user:password in a URL, an account
identifier, an endpoint.  An interval join within the scope (one
text) links parts whose starts are at most ``reach`` code points apart: a short secret is
reported only beside an identifier or access key (the user in a URL is one), an identifier only beside a secret, an
endpoint only beside both.  The join is a range window over the parts of one text in order
of place, so no pair of parts is ever written out.  A weak secret inside another reported
secret is not reported again.

Places are code points, the end excluded.  A null or empty text has no span.  Rows with the
same doc_id and text are answered alike; a null doc_id is a value like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import read_table, stored, text_or_empty

REACH = 200
MASK = "[REDACTED]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    value_group: int  # the group whose length decides
    least: int  # code points for a strong span; 0: never strong
    weak_name: str = ""  # the kind of a span that is not strong
    weak_least: int = 0


# The kinds in the order that sorts equal starts.
KINDS = (
    Kind("assign", r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8, "weak_secret", 4),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
    Kind("", r"""((?i)username|user_?id|login|account|client_?id|access_?key_?id)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""",
         2, 0, "identifier", 3),
    # a secret-like name that goes on after the keyword; "assign" has the names that end with one
    Kind("", r"""((?i)(?:secret|passwd|password|token|api_?key)[_.-][a-z0-9_.-]{1,32}"""
             r"""|(?:secret|private|access|account|auth|encryption|signing|shared|storage|master)(?:[_.-]?access)?[_.-]?key"""
             r"""|pwd|pass_?phrase|credentials?)"""
             r"""(?<!password|passwd|secret|token|api_?key|key_?id)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 0, "weak_secret", 4),
    # a bare string with small and capital letters and digits; not a piece of a path or a name
    Kind("", r"""(?<![A-Za-z0-9+/_.@%?&-])(?=[A-Z0-9+/]{0,127}[a-z])(?=[a-z0-9+/]{0,127}[A-Z])(?=[A-Za-z+/]{0,127}[0-9])"""
             r"""[A-Za-z0-9+/]{40,128}={0,2}(?![A-Za-z0-9+/=_@%-]|\.[A-Za-z0-9])""",
         0, 0, "weak_secret", 40),
    # user:password@ in a URL, and the user as its identifier
    Kind("", r"""(?<=://)[^\s/:@"'<>]{1,64}:([^\s/:@"'<>]{4,128})@""", 1, 0, "weak_secret", 4),
    Kind("", r"""(?<=://)[^\s/:@"'<>]{1,64}(?=:[^\s/:@"'<>]{4,128}@)""", 0, 0, "identifier", 1),
    Kind("", r"https?://[A-Za-z0-9.:/_-]+", 0, 0, "endpoint", 12),
)
BASE = ("assign", "access", "hex")
RANK = {name: i for i, name in enumerate((*BASE, "weak_secret", "identifier", "endpoint"))}


def _found(body: Column, k: Kind) -> Column:
    """The kind's matches as an array of (gap before, length, length of the value)."""
    values = F.regexp_extract_all(body, F.lit(k.pattern), F.lit(k.value_group))
    whole = F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)) if k.value_group else values
    gaps = F.split(body, k.pattern, -1)
    return F.when(body.rlike(k.pattern), F.zip_with(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(values)).alias("gap"), whole.alias("all")), values,
        lambda g, v: F.struct(F.length(g["gap"]).alias("gap"), F.length(g["all"]).alias("n"), F.length(v).alias("v"))))


def _parts(found: DataFrame) -> DataFrame:
    """A row (doc_id, h, kind, rank, start, end) for each strong span and weak part; each text once."""
    each = None
    for i, k in enumerate(KINDS):
        one = found.filter(F.size(f"k{i}") > 0).dropDuplicates(["doc_id", "h"]).select(
            "doc_id", "h", F.posexplode(f"k{i}").alias("i", "m"))
        before = Window.partitionBy("doc_id", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("m.gap") + F.col("m.n")).over(before)
        kind = F.lit(None).cast("string")
        if k.weak_name:
            kind = F.when(F.col("m.v") >= k.weak_least, F.lit(k.weak_name))
        if k.least:
            kind = F.when(F.col("m.v") >= k.least, F.lit(k.name)).otherwise(kind)
        one = one.select("doc_id", "h", kind.alias("kind"), (end - F.col("m.n")).alias("start"), end.alias("end"))
        one = one.filter(F.col("kind").isNotNull())
        each = one if each is None else each.unionByName(one)
    rank = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])
    return each.withColumn("rank", rank[F.col("kind")])


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """Drop weak parts without their complement within reach."""
    near = Window.partitionBy("doc_id", "h").orderBy("start").rangeBetween(-reach, reach)
    has = lambda *kinds: F.max(F.col("kind").isin(*kinds)).over(near)
    seen = parts.withColumn("_secret", has("assign", "weak_secret")).withColumn("_id", has("access", "identifier"))
    keep = (F.col("kind").isin(*BASE)
            | ((F.col("kind") == "weak_secret") & F.col("_id"))
            | ((F.col("kind") == "identifier") & F.col("_secret"))
            | ((F.col("kind") == "endpoint") & F.col("_id") & F.col("_secret")))
    # a weak secret inside a secret that starts before it, or at the same place and ends later
    outer = (Window.partitionBy("doc_id", "h").orderBy("start", F.desc("end"), "rank")
             .rowsBetween(Window.unboundedPreceding, -1))
    reached = F.max(F.when(F.col("kind").isin(*BASE, "weak_secret"), F.col("end"))).over(outer)
    again = (F.col("kind") == "weak_secret") & (F.col("end") <= F.coalesce("_reached", F.lit(-1)))
    return seen.filter(keep).withColumn("_reached", reached).filter(~again).drop("_secret", "_id", "_reached")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """A row per document: doc_id, h (hash of the text), spans: array of (start, rank, end, kind) in order."""
    body = text_or_empty(text)
    found = stored(docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("h"),
                               *[_found(body, k).alias(f"k{i}") for i, k in enumerate(KINDS)]), "secret-matches")
    spans = _linked(_parts(found), reach).groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
    rows, s = found.select("doc_id", "h").alias("r"), spans.alias("s")
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.h") == F.col("s.h"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return rows.join(s, same, "left").select("r.doc_id", "r.h", F.coalesce(F.col("s.spans"), none).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The documents with each reported span replaced by a mask; all columns stay, n_chars follows."""
    hits = scan_secrets(docs, reach=reach).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "h"])
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), F.col("spans").alias("_spans"))
    cut = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                F.lit(MASK))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length(F.col("text")))))
    joined = docs.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_or_empty()) == F.col("_h")), "left")
    masked = F.when(F.col("_spans").isNotNull(), cut).otherwise(F.col("text"))
    out = joined.withColumn("text", masked)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(spans_text(base), 256).alias("base_sha256"),
                      spans_text(F.col("spans")).alias("spans"))
