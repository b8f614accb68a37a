"""Operators that compare documents or vectors, against brute force."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripwright.llm import hnsw, jaccard_join, lempel_ziv_dedup, shared_windows, suffix_dedup
from tripwright.llm.common import written
from tripwright.llm.components import components
from tripwright.llm.shared_windows import Context, Contexts, GroupContexts, bucket_of, concatenated, contexts_of, stretches

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def place(i):
    return -(2**63) if i is None else i


def plain_windows(rows, width):
    """Removed units of rows (id, units)."""
    first = {}
    for i, units in sorted(rows, key=lambda r: place(r[0])):
        for p in range(len(units) - width + 1):
            first.setdefault(units[p : p + width], place(i))
    out = []
    for i, units in rows:
        gone = np.zeros(len(units), bool)
        for p in range(len(units) - width + 1):
            if first[units[p : p + width]] < place(i):
                gone[p : p + width] = True
        out.append((i, units, gone))
    return out


@pytest.fixture(scope="module")
def some(docs):
    return docs.where("length(text) < 3000")


@pytest.mark.parametrize("which", ["some", "odd", "none"])
@pytest.mark.parametrize("group_bytes", [12 << 20, 30_000])
def test_suffix_dedup(request, which, group_bytes):
    frame = request.getfixturevalue(which)
    rows = [(i, (t or "").encode()) for i, t in frame.select("doc_id", "text").collect()]
    want = []
    for i, text, gone in plain_windows(rows, 50):
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want.append((i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.drop_repeated_bytes(frame, group_bytes=group_bytes).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("which", ["some", "odd", "none"])
@pytest.mark.parametrize("group_bytes", [12 << 20, 30_000])
def test_substring_dedup(request, which, group_bytes):
    frame = request.getfixturevalue(which)
    rows = [(i, tuple(WORD.findall(t or ""))) for i, t in frame.select("doc_id", "text").collect()]
    want = []
    for i, words, gone in plain_windows(rows, 13):
        kept = " ".join(w for w, x in zip(words, gone, strict=True) if not x)
        want.append((i, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    got = lempel_ziv_dedup.drop_repeated_words(frame, group_bytes=group_bytes).drop("kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def plain_masks(contexts, width, cut):
    out = []
    for c in contexts:
        units, mask = cut(c.units), 0
        for w in range(c.windows):
            for o in contexts:
                other = cut(o.units)
                at = w - c.anchor + o.anchor
                if o.least < c.least and 0 <= at < o.windows and other[at : at + width] == units[w : w + width]:
                    mask |= 1 << w
        out.append(mask)
    return out


def test_contexts_of_a_group_take_little_memory():
    rng = np.random.default_rng(3)
    passages = [bytes(rng.integers(97, 123, 400, dtype=np.uint8)).decode() for _ in range(40)]
    texts = pa.array(["".join(passages[k] for k in rng.permutation(40)) for _ in range(60)], pa.large_string())
    found, ids = GroupContexts(7), np.arange(60) * 3
    assert len(list(stretches(suffix_dedup.KIND, texts))) == 1  # makes tables that stay
    tracemalloc.start()
    for at, runs, first, cut in stretches(suffix_dedup.KIND, texts):
        hit = np.arange(len(runs.key))
        found.add(runs, hit, at + runs.doc, runs.start - first[runs.doc], ids[at + runs.doc], cut, suffix_dedup.LENGTH)
        del runs, first, cut
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    sent, of_doc, places = found.packed()
    assert (np.diff(of_doc) >= 0).all() and sum(count for _, count, _, _ in sent) == len(found.places)
    assert taken < 60 * len(of_doc) + 300 * len(found.places)
    # each context that is sent stands where its first run says, and later equal runs are told to go as a whole
    contexts = {b: Contexts([row]) for b, *row in sent}
    seen = set()
    for doc, start, windows, bucket, place in zip(of_doc.tolist(), *places.tolist(), strict=True):
        content = texts[doc].as_py()[start : start + windows + suffix_dedup.LENGTH - 1].encode()
        if place >= 0:
            assert contexts[bucket].cut(place) == content
            assert contexts[bucket].least[place] == ids[doc]
            seen.add(content)
        else:
            assert content in seen


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=6, max_size=14), st.integers(0, 5)), min_size=1, max_size=9))
def test_suffix_sort_on_short_windows(parts):
    contexts = [Context(7, t.encode(), i, len(t) - 3, 0) for t, i in parts]
    assert suffix_dedup.resolve(contexts, 4) == plain_masks(contexts, 4, lambda u: u)


def beside_a_line(n, seed=11):
    """Contexts of the last anchor of a line that many documents hold, with own bytes behind it."""
    draw = np.random.default_rng(seed)
    texts = pa.array([bytes(b"A line that stands in very many documents, of more than fifty bytes.\n") + bytes(x) for x in draw.integers(97, 123, (n, 40), dtype=np.uint8)])
    ((_, runs, _, cut),) = stretches(suffix_dedup.KIND, concatenated(pa.chunked_array([texts.cast(pa.string())])))
    key = max((k for k, c in Counter(runs.key.tolist()).items() if c == n), key=lambda k: int(runs.start[runs.key == k].max() % 109))
    at = np.flatnonzero(runs.key == key)
    return [Context(7, cut(s, s + w + 49), k, w, a) for k, (s, w, a) in enumerate(zip(runs.start[at].tolist(), runs.windows[at].tolist(), runs.anchor[at].tolist(), strict=True))]


@pytest.mark.parametrize("n", [500, 4_000])
def test_a_common_anchor_takes_few_comparisons(monkeypatch, n):
    contexts, pairs = beside_a_line(n), []
    plain = suffix_dedup.Suffixes.extension
    monkeypatch.setattr(suffix_dedup.Suffixes, "extension", lambda self, a, b: pairs.append(len(a)) or plain(self, a, b))
    masks = suffix_dedup.resolve(contexts)
    first, want = {}, [0] * n
    for k, c in enumerate(contexts):
        for w in range(c.windows):
            if first.setdefault((c.anchor - w, c.units[w : w + 50]), k) < k:
                want[k] |= 1 << w
    assert masks == want and any(masks)
    # a sort of all windows took 18 for each of 500 contexts and 38 for each of 4,000
    assert sum(pairs) < 5 * sum(c.windows for c in contexts)


def test_a_common_anchor_is_compared_a_part_at_a_time(monkeypatch):
    contexts = beside_a_line(3_000) + [Context(8, c.units, c.least, c.windows, c.anchor) for c in beside_a_line(200, 12)]
    whole = suffix_dedup.resolve(contexts)
    monkeypatch.setattr(suffix_dedup, "WINDOWS_AT_ONCE", 4_000)
    monkeypatch.setattr(suffix_dedup, "SORTED_AT_ONCE", 100)
    lots, plain = [], suffix_dedup.same_windows
    monkeypatch.setattr(suffix_dedup, "same_windows", lambda units, at, *x: lots.append(len(at)) or plain(units, at, *x))
    assert suffix_dedup.resolve(contexts) == whole
    assert len(lots) > 5 and max(lots) < 8_000


def test_windows_with_one_tag_are_told_apart_by_their_bytes(monkeypatch):
    contexts = beside_a_line(60) * 2
    contexts = [Context(c.key, c.units, k, c.windows, c.anchor) for k, c in enumerate(contexts)]
    whole = suffix_dedup.resolve(contexts)
    monkeypatch.setattr(suffix_dedup, "row_tags", lambda rows, seed: np.zeros(len(rows), np.uint64))
    assert suffix_dedup.resolve(contexts) == whole and all(whole[60:])


@pytest.mark.parametrize("operator", [suffix_dedup.drop_repeated_bytes, lempel_ziv_dedup.drop_repeated_words])
def test_many_groups_send_fewer_rows(some, monkeypatch, operator):
    assert [shared_windows.bucket_count(n) for n in (1, 21, 105, 1_230)] == [1, 21, 96, 410]
    whole = sorted(map(tuple, operator(some).drop("kept").collect()), key=repr)
    monkeypatch.setattr(shared_windows, "LEAST_BUCKETS", 2)
    kept, sent = shared_windows.written, {}

    def recorded(df, name):
        sent[name] = kept(df, name)
        return sent[name]

    monkeypatch.setattr(shared_windows, "written", recorded)
    assert sorted(map(tuple, operator(some, group_bytes=30_000).drop("kept").collect()), key=repr) == whole
    groups, buckets = (sent["contexts"].where("count is not null").agg(F.countDistinct(x)).first()[0] for x in ("grp", "bucket"))
    assert groups > 5 and buckets < groups
    # the answers are written, and so the contexts' shuffle let go, before texts are shuffled again
    assert sent["masks"].count() == sent["contexts"].where("bucket is not null").count()


def test_suffix_sort_order_and_collisions():
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 99, 600).tolist())
    suffixes = suffix_dedup.Suffixes(text, 12)
    at = np.arange(500)
    order = suffixes.sort(at, np.zeros(500, np.int64))
    assert [text[p : p + 12] for p in order] == sorted(text[p : p + 12] for p in at)
    suffixes.prefix[:] = 0  # all hashes collide: the bytes decide
    assert suffixes.extension(np.array([0]), np.array([1]))[0] == next(k for k in range(12) if text[k] != text[k + 1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("ab"), min_size=4, max_size=12), st.integers(0, 5)), min_size=1, max_size=9))
def test_parse_on_short_windows(parts):
    contexts = [Context(7, " ".join(w).encode(), i, len(w) - 3, 0) for w, i in parts]
    got = lempel_ziv_dedup.resolve(contexts, 4)
    for c, mask in zip(contexts, got, strict=True):
        words = c.units.split()
        known = {tuple(o.units.split()[p : p + 4]) for o in contexts if o.least < c.least for p in range(len(o.units.split()) - 3)}
        assert mask == sum(1 << p for p in range(len(words) - 3) if tuple(words[p : p + 4]) in known)


def plain_components(rows):
    sets = {}
    for i, t in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        found = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()
        sets.setdefault(place(i), []).append(found)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    flat = [(i, s) for i, some in sets.items() for s in some]
    for k, (i, s) in enumerate(flat):
        common = Counter(j for e in s for j in holders[e])
        for j, n in common.items():
            if 100 * n >= 90 * (len(s) + len(flat[j][1]) - n):
                a, b = root(i), root(flat[j][0])
                parent[max(a, b)] = min(a, b)
        for e in s:
            holders[e].add(k)
    shown = lambda i: None if i == -(2**63) else i
    return sorted(((shown(i), len(s), shown(root(i))) for i, s in flat), key=repr)


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
@pytest.mark.parametrize("block", [1_000_000, 150])
def test_jaccard_components(request, which, block):
    frame = request.getfixturevalue(which)
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    got = jaccard_join.linked_components(frame, block=block).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_signatures_meet_for_every_link(size, less, more, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    one = np.unique(draw(size))
    other = np.unique(np.concatenate([rng.permutation(one)[min(less, len(one)) :], draw(more)]))
    if not len(other):
        return
    common = len(np.intersect1d(one, other))
    if 100 * common >= 90 * (len(one) + len(other) - common):
        assert np.intersect1d(jaccard_join.signatures(one), jaccard_join.signatures(other)).size


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 400), st.integers(0, 90), st.integers(0, 90), st.integers(0, 2**32))
def test_signatures_meet_at_four_fifths(size, less, more, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    one = np.unique(draw(size))
    other = np.unique(np.concatenate([rng.permutation(one)[min(less, len(one)) :], draw(more)]))
    if len(other) and 100 * (common := len(np.intersect1d(one, other))) >= 80 * (len(one) + len(other) - common):
        assert np.intersect1d(jaccard_join.signatures(one, 80), jaccard_join.signatures(other, 80)).size


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 60), st.sampled_from([80, 90]), st.integers(0, 2**32))
def test_rarest_shingles_meet_for_every_link(size, less, more, percent, seed):
    rng = np.random.default_rng(seed)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    one = np.unique(draw(size))
    other = np.unique(np.concatenate([rng.permutation(one)[min(less, len(one)) :], draw(more)]))
    keys, sizes = np.concatenate([one, other]), np.array([len(one), len(other)])
    power = {k: rng.integers(0, 4) for k in set(keys.tolist())}
    chosen = jaccard_join.rarest(keys, np.array([power[k] for k in keys.tolist()], np.uint8), sizes, percent)
    first, second = chosen[chosen < len(one)], chosen[chosen >= len(one)]
    assert len(first) == len(one) - -(-len(one) * percent // 100) + 1
    if len(other) and 100 * (common := len(np.intersect1d(one, other))) >= percent * (len(one) + len(other) - common):
        assert np.intersect1d(keys[first], keys[second]).size


def test_common_shingles_count_over_all_chunks(spark):
    rows = [(k, " ".join(["all of them hold this passage", *(f"w{k}x{j}" for j in range(8))])) for k in range(40)]
    chunks = spark.createDataFrame([(k // 3, t) for k, t in rows], "chunk long, text string").coalesce(2)
    found = jaccard_join.common_shingles(jaccard_join.chunk_counts(chunks, 3, 5)).collect()
    heard = defaultdict(dict)
    for r in found:
        heard[r.chunk] |= dict(zip(np.frombuffer(r["keys"], np.uint64).tolist(), r["powers"], strict=True))
    # four runs of three words that all 40 hold, in each of the 14 chunks
    assert [sorted(heard[c].values()) for c in range(14)] == [[5] * 4] * 14
    assert len({frozenset(x) for x in heard.values()}) == 1


def test_a_cluster_of_shared_passages_is_cut(spark):
    passages = [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(3)]
    own = lambda k: " ".join(f"d{k}w{j}" for j in range(20))
    rows = [(k, f"{own(k // 2)} {passages[k // 2 % 3]} {'end' if k % 2 else 'last'}") for k in range(0, 60)]
    rows += [(100 + k, f"{passages[k % 3]} {own(1000 + k)} {passages[(k + 1) % 3]}") for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    base = jaccard_join.described(frame, "doc_id", "text", 3).select("h1", "h2", "id", "t", "n").withColumn("cluster", F.lit(7))
    cut = jaccard_join.cut_again(frame, base, "doc_id", "text", 3, 90, 500).collect()
    sizes = Counter(r.cluster for r in cut)
    assert len(cut) == 60 and set(sizes.values()) == {2}
    got = jaccard_join.linked_components(frame, block=500).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)


@pytest.mark.parametrize("block", [1_000_000, 150])
@pytest.mark.parametrize("shared", [9, None])
def test_sets_of_one_id_keep_their_links(spark, shared, block):
    text = lambda name: " ".join(f"{name}{k}" for k in range(120))
    near = lambda name: text(name).replace(f"{name}60 ", "other ")
    rows = [(shared, text("a")), (shared, text("b")), (shared, text("b")), (shared, ""), (20, near("a")), (30, near("b"))]
    rows += [(40, text("c")), (50, text("c")), (50, text("d")), (50, None), (60, near("d")), (70, None), (70, text("e")), (5, text("f"))]
    got = jaccard_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert sorted(map(tuple, got), key=repr) == plain_components(rows)
    assert {r.component_id for r in got if r.doc_id in (20, 30)} == {shared}
    assert {r.component_id for r in got if r.doc_id in (40, 50, 60)} == {40}


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_nearest(vectors, queries, k):
    out = {}
    for q, x in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), i) for i, v in vectors if i != q and len(v) == len(x))
        out[q] = near[:k]
    return out


def usable(rows):
    return sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})


@pytest.mark.parametrize("shard_rows", [8_192, 120])
def test_nearest_reaches_recall(spark, sf_dir, shard_rows):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = usable((r.vec_id, r.embedding) for r in frame.collect())
    asked = [r for r in rows if r[0] % 20 == 0]
    got = defaultdict(list)
    for r in hnsw.search(frame, frame.where("vec_id % 20 = 0"), shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.score, r.vec_id))
    want = plain_nearest(rows, asked, 10)
    hits = 0
    for q, near in want.items():
        assert got[q] == sorted(got[q])
        hits += len({i for _, i in near} & {i for _, i in got[q]})
        exact = dict((i, d) for d, i in near)
        assert all(abs(exact[i] - d) < 1e-9 for d, i in got[q] if i in exact)
    assert hits >= 0.9 * 10 * len(want)


def test_nearest_cases(spark):
    rows = [(k, [1.0, 2.0], "clash") for k in range(40)] + [(50, [0.0, 0.0], "z"), (51, None, "z"), (52, [float("nan"), 1.0], "z"), (53, [1.0, None], "z"), (None, [1.0, 1.0], "z"), (60, [3.0, 2.0], "z"), (61, [1.0, 2.0, 3.0], "z"), (60, [3.0, 2.0], "z")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard string")
    got = hnsw.search(frame, frame.where("vec_id in (3, 60, 50, 61)"), shard_rows=16).orderBy("query_id", "rank").collect()
    found = defaultdict(list)
    for r in got:
        found[r.query_id].append((r.vec_id, r.score))
    assert found[3] == [(k, 0.0) for k in (0, 1, 2, 4, 5, 6, 7, 8, 9, 10)]
    assert found[60] == [(k, 2.0) for k in range(10)]
    assert set(found) == {3, 60}
    assert hnsw.search(frame.limit(0), frame).count() == 0


@pytest.mark.parametrize("scale", [1e19, 1e-30, 1e200, 1e-200])
def test_nearest_at_any_scale(spark, scale):
    draw = np.random.default_rng(5)
    rows = [(k, [float(x) for x in draw.normal(size=8) * scale]) for k in range(300)] + [(300, [scale * 1e100] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in hnsw.search(frame, frame.where("vec_id < 5")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    plain = np.array([v for _, v in rows[:300]]) / scale
    want = {q: set(np.argsort(((plain - plain[q]) ** 2).sum(1), kind="stable")[1:11].tolist()) for q in range(5)}
    assert sum(len(found[q] & want[q]) for q in want) >= 45


@pytest.mark.parametrize("at", [(1 << 19) - 25, (1 << 20) - 25, (1 << 20) + 7])
def test_passages_in_texts_above_a_mebibyte(spark, at):
    """Places of anchors are right wherever a passage lies in a long text."""
    draw = np.random.default_rng(at)
    letters = draw.integers(97, 123, 1_200_000).astype(np.uint8).tobytes().decode()
    rows = [(1, "ab" * 30), (2, letters[:at] + "ab" * 30 + letters[at + 60 :])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in suffix_dedup.drop_repeated_bytes(frame).collect()} == {1: 0, 2: 60}
    passage = " ".join("pq"[k % 2] for k in range(40))
    words = " ".join(letters[k : k + 5] for k in range(0, len(letters), 5))
    rows = [(1, passage), (2, words[: at // 6 * 6] + passage + words[at // 6 * 6 - 1 :])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lempel_ziv_dedup.drop_repeated_words(frame).collect()} == {1: 0, 2: 40}


def test_a_group_holds_a_part_of_its_contexts_at_once():
    rng = np.random.default_rng(5)
    texts = pa.array([bytes(rng.integers(97, 123, 20_000, dtype=np.uint8)).decode() for _ in range(40)] * 2, pa.large_string())
    ids, buckets, width = np.arange(80) * 3, 32, suffix_dedup.LENGTH
    held = [(at, runs.at(np.arange(len(runs.key))), first, cut) for at, runs, first, cut in stretches(suffix_dedup.KIND, texts)]
    whole = GroupContexts(buckets)
    tracemalloc.start()
    for at, runs, first, cut in held:
        whole.add(runs, np.arange(len(runs.key)), at + runs.doc, runs.start - first[runs.doc], ids[at + runs.doc], cut, width)
    sent, of_doc, places = whole.packed()
    del whole
    at_once = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    in_lots = contexts_of(held, ids, buckets, width)
    assert tracemalloc.get_traced_memory()[1] - before < 0.6 * at_once
    # the same is sent, and the same runs are told the same
    assert in_lots[0] == sent
    told = [sorted(zip(doc.tolist(), *x.tolist(), strict=True)) for doc, x in ((of_doc, places), in_lots[1:])]
    assert told[0] == told[1]
    # unpacking a bucket holds its units once
    rows = [row for _, *row in sent]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    bucket = Contexts(rows)
    assert tracemalloc.get_traced_memory()[1] - before < 1.3 * len(bucket.units) + 40 * len(bucket.keys)
    tracemalloc.stop()


@pytest.mark.parametrize("kind", [suffix_dedup.KIND, lempel_ziv_dedup.KIND])
def test_buckets_of_anchors_are_even(kind):
    rng = np.random.default_rng(8)
    texts = pa.array([" ".join(map(str, rng.integers(0, 10**6, 20_000).tolist()))], pa.large_string())
    ((_, runs, _, _),) = stretches(kind, texts)
    held = np.bincount(bucket_of(runs.key, 40), minlength=40)
    assert held.max() < 2 * held.mean()


def test_grams_are_hashed_a_part_at_a_time():
    data = np.random.default_rng(6).integers(97, 123, 1 << 20, dtype=np.uint8)
    suffix_dedup.byte_grams(data, np.array([0, len(data)]))  # makes tables that stay
    prefix, inverse = suffix_dedup.prefix_hashes(data)
    n = len(data) - suffix_dedup.GRAM + 1
    want = suffix_dedup.mixed((prefix[suffix_dedup.GRAM :] - prefix[:n]) * inverse[:n])
    tracemalloc.start()
    grams, _, cut = suffix_dedup.byte_grams(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (grams == want).all() and cut(5, 40) == data[5:40].tobytes()
    assert peak < 2 * want.nbytes


def test_a_round_of_components_joins_each_edge_once(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append((name, df.columns, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))
        return written(df, name)

    monkeypatch.setattr("tripwright.llm.components.written", kept)
    edges = [(k, k + 1) for k in range(3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(4), 0)
    rounds = [x for x in plans if x[0] == "labels"][1:]
    # the jump's two sides have the same labels, each with the offers and the hooks of one join; the old label needs none
    assert rounds and all("old" in columns and joins <= 5 for _, columns, joins in rounds)
