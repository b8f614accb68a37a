"""The k-d tree of shards and the centroid clusters, against plain versions."""

import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from tripwright.llm import centroid_clusters, kd_shards, queries

NULL = -(1 << 63)


def plain_shards(rows, shards):
    """Shard of each row, given as (size, *metadata, id, checksum): cuts at exact quantiles, dimension by dimension."""
    dims = len(rows[0]) - 2
    spans = [(min(r[d] for r in rows), max(r[d] for r in rows)) for d in range(dims)]

    def parts(some):
        return [(max(r[d] for r in some) - min(r[d] for r in some)) / max(1, top - bottom) for d, (bottom, top) in enumerate(spans)]

    def cut(some, first, count):
        if count == 1 or not some:
            return [(r, first) for r in some]
        widths = parts(some)
        dim, left, total = widths.index(max(widths)), count // 2, sum(r[0] for r in some)
        some = sorted(some, key=lambda r: (r[dim], r[dims], r[dims + 1]))
        held, at = 0, 0
        while (held + some[at][0]) * count < total * left:
            held, at = held + some[at][0], at + 1
        over, under = (held + some[at][0]) * count - total * left, total * left - held * count
        at += over < under
        return cut(some[:at], first, left) + cut(some[at:], first + left, count - left)

    return cut(rows, 0, shards)


def as_rows(frame):
    out = []
    for r in frame.collect():
        text = (r["text"] or "").encode()
        code = lambda x: -1 if x is None else zlib.crc32(x.encode())
        chars = -1 if r["n_chars"] is None else r["n_chars"]
        out.append((len(text) + 16, code(r["lang"]), code(r["source"]), chars, NULL if r["doc_id"] is None else r["doc_id"], zlib.crc32(text)))
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
@pytest.mark.parametrize("shards", [1, 7, 40])
def test_the_tree_cuts_at_exact_quantiles(request, which, shards):
    frame = request.getfixturevalue(which)
    rows = as_rows(frame)
    want = sorted((s, r[-2], r[-1], r[0]) for r, s in plain_shards(rows, shards))
    got = kd_shards.summary(frame, shards=shards, tolerance=0).collect()
    assert sorted((r.shard, NULL if r.doc_id is None else r.doc_id, r.text_crc32, r["size"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sizes_are_near_equal(spark, sf_dir):
    out = queries.op11_kd_shards(spark, sf_dir)
    got = out.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    total, largest = sum(r.bytes for r in got), out.agg(F.max("size")).first()[0]
    assert {r.shard for r in got} == set(range(40))
    assert all(abs(r.bytes - total / 40) <= 3 * largest for r in got)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert {(r.law, r.grown_shard) for r in out.select("law", "grown_shard").collect()} == {("bytes", None)}


def test_one_text_id_and_source_of_a_third_of_all_rows(spark):
    """Repeated rows, null ids too, are cut like any others."""
    rows = [(None, "same text of all of these", "hot")] * 300 + [(k, f"text {k} " + "x" * (k % 50), f"s{k % 9}") for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = kd_shards.summary(frame, shards=10).collect()
    held = [sum(r["size"] for r in out if r.shard == s) for s in range(10)]
    assert len(out) == 900
    assert max(held) - min(held) <= 3 * 80
    assert sum(r.doc_id is None for r in out) == 300
    again = kd_shards.summary(frame.repartition(3), shards=10).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_shards_of_empty_and_one_row(spark, none, tmp_path):
    assert kd_shards.summary(none).collect() == []
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in kd_shards.summary(one).collect()][0][:4] == (1, 16, 0, "bytes")
    many = spark.createDataFrame([(k, "t" * 84) for k in range(50)], "doc_id long, text string")
    kd_shards.write_shards(many, str(tmp_path / "out"), target_bytes=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.groupBy("shard").count().toPandas()["count"]) == [10] * 5
    assert {(r.doc_id, r.text) for r in back.collect()} == {(k, "t" * 84) for k in range(50)}


def plain_clusters(rows, clusters=40, rounds=5, dimensions=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:clusters]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        chosen = assigned()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, chosen, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    chosen = assigned()
    inertia = [sum(d for d, c in chosen if c == k) for k in range(len(centroids))]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), hashes[c]) for (i, _), (d, c) in zip(kept, chosen, strict=True)), key=repr)


def test_clusters(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op12_centroids(spark, sf_dir).collect()), key=repr) == plain_clusters(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [9.0, -1.0]), (2, None), (3, [1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [None, 1.0]), (None, [0.0, 0.0])]
    rows += [(7, [1.0, 2.0, 3.0]), (8, [-0.001, 0.0039]), (9, [1e-300, -1e-300])] + [(10 + k, [4.0, 4.0]) for k in range(20)] + [(40 + k, [k / 7, k / 3]) for k in range(20)]
    frame = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int").repartition(3)
    for clusters in (3, 100):
        want = plain_clusters(rows, clusters, 5, 2)
        assert sorted(map(tuple, centroid_clusters.summary(frame, clusters=clusters, dimensions=2).collect()), key=repr) == want
    assert centroid_clusters.summary(frame).collect() == []


def test_components_past_the_bound_are_held(spark):
    frame = spark.createDataFrame([(1, [1e300, -1e300]), (2, [524_288.0, -524_288.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in centroid_clusters.summary(frame, clusters=3, dimensions=2, rounds=1).collect()}
    assert got[1].cluster == got[2].cluster != got[3].cluster
    assert {r.distance for r in got.values()} == {0}
    one = centroid_clusters.summary(frame, clusters=1, dimensions=2, rounds=1).collect()
    assert {r.inertia for r in one} == {sum(r.distance for r in one)}
