"""Secret scans over a ledger of content-addressed blobs.

A text is a blob named by its sha-256. The ledger holds, for every blob seen, the rules (name and version) that were run on it and
the spans they found. A scan of a history of paths reads the ledger, runs only the (blob, rule version) pairs that it lacks,
appends them, and joins findings back to every path that holds the blob. Copies of one text are one blob, however many they are.

Positions come from built-in functions: the matches of a rule and the gaps between them (a split by the same pattern) alternate, so
running sums of their lengths are the limits of each match in code points. They are taken over the rows of one blob and rule, and blobs are
already dealt by their name, so time and memory are linear in the matches and nothing is shuffled for it. Masked texts are put
together from pieces of a fixed length.

Defined cases: a null text is an empty blob; an empty history adds nothing; equal rows give equal results; columns of the input other
than its path and text are carried along untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.llm.common import cut, fresh_folder, query, read


@dataclass(frozen=True)
class Rule:
    """kind: name in spans; pattern: Java and RE2; group, least: this group of a match must have so many characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
#: further rules of this ledger, listed after the base ones
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 24),
)
#: a cheap necessary condition for a match that passes, so that most texts are not cut into pieces
_NEEDS = {"hex": r"[0-9a-f]{24}", "access": r"AKIA[A-Z0-9]{16}", "pem": "PRIVATE KEY", "jwt": r"eyJ[A-Za-z0-9_-]+\."}

SPAN = "struct<start:int,place:int,end:int,kind:string>"
#: code points of the pieces from which masked texts are put together
PIECE = 4096


def alternating(text: Column, rule: Rule) -> Column:
    """array<struct<gap, size, part>>: lengths of the text before each match of a rule, of the match, and of the group that must be long enough."""
    lengths = lambda group: F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), F.length)
    return F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"), lengths(0).alias("size"), lengths(rule.group).alias("part"))


def with_spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rules (tags run), spans of blobs (blob, body, todo), one row for each blob; spans by start, then by place of the rule."""
    cuts = [F.when(F.array_contains("todo", r.tag) & F.col("body").rlike(_NEEDS.get(r.kind, r.pattern)),
                   F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), alternating(F.col("body"), r).alias("pieces")))
            for i, r in enumerate(rules)]
    each = blobs.select("blob", "todo", F.explode_outer(F.filter(F.array(*cuts), lambda x: x.isNotNull())).alias("rule"))
    each = each.select("blob", "todo", "rule.place", "rule.kind", "rule.least", F.posexplode_outer("rule.pieces").alias("nth", "piece"))
    end = F.sum(F.col("piece.gap") + F.coalesce(F.col("piece.size"), F.lit(0))).over(W.partitionBy("blob", "place").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)).cast("int")
    span = F.struct((F.col("end") - F.col("piece.size")).alias("start"), "place", "end", "kind")
    spans = F.collect_list(F.when(F.col("piece.part") >= F.col("least"), span))  # leaves out what is null
    return each.withColumn("end", end).groupBy("blob").agg(F.first("todo").alias("rules"), F.array_sort(spans).alias("spans"))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    schema = f"blob string, rules array<string>, spans array<{SPAN}>"
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)


def scan(history: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = BASE + ADDED, path: str = "doc_id", text: str = "text",
         into: str | None = None) -> tuple[DataFrame, str]:
    """Bring the ledger up to date with a history; returns (paths with their blob, folder of the entries added).

    history: one row per path and version. ledger: folder of earlier entries (None: a new ledger). The entries added are
    written to `into` (a new folder in the shared one by default), which may be the folder of the ledger itself only for append.
    """
    spark = history.sparkSession
    tags = F.array(*(F.lit(r.tag) for r in rules))
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = history.select(F.sha2(body, 256).alias("blob"), body.alias("body")).dropDuplicates(["blob"])
    if ledger:
        known = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        blobs = blobs.join(known, "blob", "left").withColumn("todo", F.array_except(tags, F.coalesce("seen", F.array().cast("array<string>"))))
        blobs = blobs.where(F.size("todo") > 0)
    else:
        blobs = blobs.withColumn("todo", tags)
    out = into or fresh_folder(spark, "ledger")
    with_spans(blobs, rules).write.mode("append").parquet(out)
    return history.select(path, F.sha2(body, 256).alias("blob")), out


def findings(ledger: DataFrame) -> DataFrame:
    """One row per blob that has any: its spans over all entries, by start, then by place of the rule."""
    hit = ledger.where(F.size("spans") > 0)
    return hit.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def gaps_of(hits: DataFrame) -> DataFrame:
    """blob, gaps (from, to: what stands before each mark), last (where the rest begins) of (blob, spans); overlapping spans become one mark."""
    each = hits.select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.place", "s.end")
    before = F.coalesce(F.max("end").over(W.partitionBy("blob").orderBy("start", "place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    fresh = F.when(F.col("start") >= F.col("before"), F.struct(F.col("before").alias("from"), F.col("start").alias("to")))
    return each.withColumn("before", before).groupBy("blob").agg(F.array_sort(F.collect_list(fresh)).alias("gaps"), F.max("end").alias("last"))


def masked(text: Column, gaps: Column, last: Column) -> Column:
    """The text with `[secret]` behind every gap, and what follows the last mark."""
    def whole(pieces):
        def part(begin, end):
            first = F.floor(begin / PIECE).cast("int")
            count = F.greatest(F.floor((end - 1) / PIECE).cast("int") - first + 1, F.lit(0))
            return F.substring(F.array_join(F.slice(pieces, first + 1, count), ""), begin - first * PIECE + 1, end - begin)

        return F.concat(F.array_join(F.transform(gaps, lambda g: F.concat(part(g["from"], g["to"]), F.lit("[secret]"))), ""), part(last, F.length(text)))

    # the pieces are a variable of the outer function, so that they are cut once and not for every gap
    return F.element_at(F.transform(F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))), whole), 1)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(history: DataFrame, text: str = "text", length: str | None = None, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """The rows with every span of their text masked, found by a new ledger; a column `length`, if named, follows the new text."""
    columns = history.columns
    _, ledger = scan(history, rules=rules, path=columns[0], text=text)
    hits = cut(gaps_of(findings(read_ledger(history.sparkSession, ledger))))
    rows = history.select(F.struct("*").alias("row"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob")).join(hits, "blob", "left")
    clean = F.when(F.col("gaps").isNotNull(), masked(F.col(f"row.{text}"), F.col("gaps"), F.col("last"))).otherwise(F.col(f"row.{text}"))
    rows = rows.select(*(clean.alias(c) if c == text else F.when(F.col("gaps").isNotNull(), F.length(clean).cast("long")).otherwise(F.col(f"row.{c}")).alias(c)
                         if c == length else F.col(f"row.`{c}`") for c in columns))
    return rows


_SQL_RULES = [(i, r) for i, r in enumerate(BASE + ADDED)]


def _oracle() -> str:
    parts = []
    for i, r in _SQL_RULES:
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {i} AS place, '{r.kind}' AS kind, {r.least} AS least,
         string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found,
         regexp_extract_all(text, '{pattern}', {r.group}) AS part
  FROM docs WHERE regexp_matches(text, '{pattern}')""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
each AS (SELECT doc_id, place, kind, least, gaps, found, part, unnest(range(1, len(found) + 1)) AS i FROM hits),
spans AS (
  SELECT doc_id, place, kind,
         (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start,
         length(found[i]) AS size
  FROM each WHERE length(part[i]) >= least),
told AS (SELECT *, kind || ':' || start || ':' || (start + size) AS span FROM spans),
per AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < {len(BASE)}), '') AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM told GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN per p ON p.doc_id = d.doc_id
"""


@query("op2_secret_scan", _oracle())
def secret_scan(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "text")
    # an earlier version of the tree held the documents of even ids, and the base rules alone were known
    _, earlier = scan(rows.where("doc_id % 2 = 0"), rules=BASE)
    paths, added = scan(rows, ledger=earlier)
    ledger = read_ledger(spark, earlier).unionByName(read_ledger(spark, added))
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    hits = cut(findings(ledger).select(
        "blob", count("assign").alias("a"), count("access").alias("k"), count("hex").alias("h"),
        F.sha2(listed(base), 256).alias("b"), listed(F.col("spans")).alias("s")))
    rows = paths.join(hits, "blob", "left")
    return rows.select("doc_id", F.coalesce("a", F.lit(0)).cast("long").alias("n_assign"), F.coalesce("k", F.lit(0)).cast("long").alias("n_access"),
                       F.coalesce("h", F.lit(0)).cast("long").alias("n_hex"), F.coalesce("b", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                       F.coalesce("s", F.lit("")).alias("spans"))
