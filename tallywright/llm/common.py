"""What several of the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.plans.lineage import checkpoint_folder, cut

__all__ = ["QUERIES", "ORACLES", "query", "read", "cut", "fresh_folder", "words_of", "arrow_map", "crc_of_id", "components_sql"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Java form of one word
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared one that the cluster names."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def words_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def arrow_map(df: DataFrame, columns: list[Column], fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str) -> DataFrame:
    """Map batches of the chosen columns by a function from a batch to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.select(*columns).mapInArrow(run, schema)


def components_sql(width: int, pct: int) -> str:
    """SQL of doc_id, n_shingles, component_id, kept: documents linked where their word shingles share pct per cent of their union."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + {width - 1}), ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {width - 2}, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= {pct} * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM w UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
o AS (SELECT node, min(seen) AS low FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, low AS component_id, doc_id = low AS kept FROM w JOIN o ON node = doc_id LEFT JOIN n USING (doc_id)"""
