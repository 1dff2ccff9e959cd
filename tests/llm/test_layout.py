"""Resharding, neighbours, components, and the pipeline as a whole."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywright.llm import components, neighbours, packing, resharding, secrets


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(8)
    for _ in range(100):
        supply = [rng.randint(0, 50) for _ in range(rng.randint(1, 6))]
        m = rng.randint(1, 6)
        got = np.zeros((len(supply), m), int)
        for t in resharding.transfers(supply, m):
            got[t.old, t.to] += t.high - t.low
        room = [sum(supply) // m + (j < sum(supply) % m) for j in range(m)]
        assert got.sum(1).tolist() == supply and got.sum(0).tolist() == room
        n = min(len(supply), m)
        assert sum(got[i, i] for i in range(n)) == sum(min(supply[i], room[i]) for i in range(n))


def test_flow_is_cheapest_under_any_costs():
    rng = random.Random(9)
    for _ in range(40):
        supply, cost = [rng.randint(0, 3) for _ in range(3)], [[rng.randint(0, 9) for _ in range(3)] for _ in range(3)]
        room = [sum(supply)] * 2 + [1]
        flow = resharding.cheapest_flow(supply, room, cost)
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min((sum(cost[i][j] for i, j in zip(units, to, strict=True)) for to in itertools.product(range(3), repeat=len(units)) if to.count(2) <= 1), default=0)
        assert sum(flow[i][j] * cost[i][j] for i in range(3) for j in range(3)) == best


def test_rewrite_places_every_row(spark, documents, odd, nothing):
    for docs in (documents, odd):
        old = docs.withColumn("file", F.concat(F.lit("f"), (F.coalesce("doc_id", F.lit(0)) % 5).cast("string"))).withColumn("old_shard", F.when(F.col("file") < "f3", 0).otherwise(1))
        placed, files = resharding.rewrite(old, old_shards=2, new_shards=4, block_bytes=2_000)
        rows = placed.collect()
        assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(r.doc_id), str(r.text)) for r in docs.collect())
        sizes = {}
        for shard in {r.shard for r in rows}:
            here = [r for r in rows if r.shard == shard]
            assert sorted(r.slot for r in here) == list(range(len(here)))
            sizes[shard] = sum(len((r.text or "").encode()) + 1 for r in here)
        if docs is documents:
            assert max(sizes.values()) - min(sizes.values()) < 2 * max(len(r.text.encode()) for r in rows)
        stay = {r.file for r in files.collect() if r.stays}
        assert all(not r.moved for r in rows if r.file in stay)
    empty = nothing.withColumn("file", F.lit("f")).withColumn("old_shard", F.lit(0))
    assert resharding.rewrite(empty, 2, 4)[0].count() == 0


def plain_nearest(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in good:
        if q % 50 == 0:
            near = sorted((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i) for i, b in good if i != q and len(a) == len(b))
            out[q] = [i for _, i in near[:k]]
    return out


def test_neighbours_of_small_and_odd_tables(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 400)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(60)]  # one vector many times: ties go to the smaller id
    rows += [(2000, None), (2050, [0.0] * 6), (2100, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2150, [float("nan")] * 6), (2200, [float("inf")] * 6), (2250, []), (2300, [1.0]), (2301, [-2.0]), (2302, [0.5])]
    table = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")), "vec_id", "embedding")
    want = plain_nearest(rows)
    for block_rows in (64, 10_000):
        got = {}
        for r in neighbours.nearest(table.where("id % 50 = 0"), table, block_rows=block_rows, query_rows=4).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got.keys() == want.keys()
        assert np.mean([len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]) >= 0.9
        assert got[2300] == want[2300] == [2302, 2301]
        assert got[1000] == want[1000]
    assert neighbours.nearest(table.where("false"), table.where("false")).count() == 0
    few = table.where("id <= 100 and id >= 98")
    assert neighbours.nearest(few.where("id = 100"), few).count() == 2


def test_repeated_rows_lose_no_neighbour(spark):
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=6).tolist() for i in range(1, 60)}
    vectors[70] = vectors[71] = vectors[50]
    rows = [*vectors.items(), *[(50, vectors[50])] * 7, (70, vectors[70]), (50, rng.normal(size=6).tolist())]
    table = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = neighbours.search(table.where("id % 50 = 0"), table).where("vec_id IS NOT NULL")
    assert got.select("query").distinct().count() == 2  # one id with two vectors asks twice
    top = [r.vec_id for r in neighbours.nearest(table.where("id % 50 = 0"), table).where("score > 0.999999").orderBy("rank").collect()]
    assert top == [70, 71]


def test_search_stops_early_on_clustered_vectors(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 48))
    v = centres[rng.integers(0, 60, 6000)] + 0.35 * rng.normal(size=(6000, 48))
    ids = np.arange(6000)
    table = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "id long, v array<double>")
    found = neighbours.search(table.where("id % 50 = 0"), table, block_rows=1000).cache()
    got = {}
    for r in found.where("vec_id IS NOT NULL").orderBy(F.desc("score"), "vec_id").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    q = np.flatnonzero(ids % 50 == 0)
    score = neighbours.cosines(v[q], v)
    score[np.arange(len(q)), q] = -9
    recall = np.mean([len(set(got[i][:5]) & set(np.argsort(-s)[:5].tolist())) / 5 for i, s in zip(q.tolist(), score, strict=True)])
    verified = found.agg(F.sum("verified")).first()[0] / (len(q) * len(ids))
    assert recall >= 0.9
    assert verified < 0.2


def test_recall_on_the_shared_vectors(spark, sf):
    table = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = neighbours.usable(table, "vec_id", "embedding")
    got = {}
    for r in neighbours.nearest(rows.where("id % 50 = 0"), rows, block_rows=1000).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ids, v = zip(*[(r.id, r.v) for r in rows.collect()], strict=True)
    ids, v = np.array(ids), np.array(v)
    q = np.flatnonzero(ids % 50 == 0)
    score = neighbours.cosines(v[q], v)
    score[np.arange(len(q)), q] = -9
    recall = np.mean([len(got[i] & set(ids[np.argsort(-s)[:5]].tolist())) / 5 for i, s in zip(ids[q].tolist(), score, strict=True)])
    assert recall >= 0.9


def test_chi_square_quantile():
    x = np.random.default_rng(1).chisquare(8, 200_000)
    assert (x < neighbours.chi_square_quantile(0.9, 8)).mean() == pytest.approx(0.9, abs=0.005)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(i, 200 + (i - 199) % 9) for i in range(200, 209)] + [(300, 300)]
    got = {r.node: r.component for r in components.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 209)}
    assert components.smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, sf, documents, tmp_path):
    docs, names = documents, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf)
        made.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
        if name != names[-1]:
            assert docs.columns == documents.columns
    assert kept["language_id"].count() == documents.count()  # all of these texts have a language
    assert kept["near_dedup"].select("doc_id").distinct().count() == kept["near_dedup"].count() < documents.count()
    secret = {r.doc_id for r in kept["near_dedup"].collect() if any(len(m.group(x.group)) >= x.least for x in secrets.BASE + secrets.ADDED for m in re.finditer(x.pattern, r.text))}
    assert kept["secret_scan"].count() == kept["near_dedup"].count()
    assert {r.doc_id for r in kept["secret_scan"].where("text like '%[secret]%'").collect()} == secret
    placed = kept["best_fit_packing"].toPandas()
    assert placed.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY
    assert set(placed["doc_id"]) == {r.doc_id for r in kept["source_mix"].select("doc_id").collect()}
    assert (placed["piece"] == 0).sum() == kept["source_mix"].count()


def test_pipeline_links_five_words_at_four_fifths(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, where = {}, defaultdict(list)
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(low))
        sets[r.doc_id] = frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        for gram in sets[r.doc_id]:
            where[gram].append(r.doc_id)
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    both = Counter(pair for ids in where.values() for pair in itertools.combinations(sorted(ids), 2))
    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()}
    assert got == {i for i in sets if find(i) == i}


def test_pipeline_rejects_texts_without_language(spark, documents):
    extra = spark.createDataFrame([(90_001, "12 34", None, "s", 5), (90_002, None, None, "s", None)], documents.schema)
    got = corpus_pipeline.language_id(spark, documents.unionByName(extra), "")
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in documents.collect()}
