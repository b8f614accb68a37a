"""The pipeline's stages, each on what the one before it kept."""

import re
from itertools import combinations

import corpus_pipeline
import pytest
from test_group_operators import WORD

import __spark_entry__ as contract

NULL = -(1 << 63)


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_stages(request, spark, sf_dir, which, tmp_path):
    frame = request.getfixturevalue(which)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, sf_dir)
        out.write.parquet(str(tmp_path / name))
        before = [r.asDict() for r in frame.collect()] if k < 4 else []
        columns, frame = frame.columns, spark.read.parquet(str(tmp_path / name))
        if k == 4:
            break
        assert frame.columns == columns
        after = frame.collect()
        if name == "language":
            assert all(re.search(r"[^\W\d_]", r.text or "") for r in after)
            named = [r for r in before if re.search(r"[^\W\d_]", r["text"] or "")]
            assert len(after) == len(named) or not any(r["lang"] for r in before)
        if name in ("lines", "secrets"):
            assert len(after) == len(before)
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
        if name == "near_copies":
            assert {r.doc_id for r in after} == plain_kept([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert frame.count() >= len(after)


def plain_kept(rows, shingle, percent):
    """Ids that are the least of their near copies, by all pairs; the texts of one id, null too, go together."""
    sets = []
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((NULL if i is None else i, {tuple(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set()))
    label = {i: i for i, _ in sets}
    for (i, a), (j, b) in combinations(sets, 2):
        common = len(a & b)
        if label[i] != label[j] and common and 100 * common >= percent * len(a | b):
            low, high = sorted((label[i], label[j]))
            label = {k: low if x == high else x for k, x in label.items()}
    return {None if i == NULL else i for i, x in label.items() if i == x}


def test_near_copies_share_four_fifths_of_runs_of_five_words(spark, docs, sf_dir):
    text = lambda at, n: " ".join(f"other{k}" if at <= k < at + n else f"word{k}" for k in range(1000))
    rows = [(1, text(0, 0)), (2, text(500, 60)), (3, text(400, 200))]
    assert (plain_kept(rows, 3, 90), plain_kept(rows, 5, 80)) == ({1, 2, 3}, {1, 3})
    for frame in (spark.createDataFrame(rows, "doc_id long, text string"), docs):
        want = plain_kept([tuple(r) for r in frame.select("doc_id", "text").collect()], 5, 80)
        assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame, sf_dir).collect()} == want


def test_registered():
    names = contract.queries()
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert set(contract.oracle_sql()) <= set(names)
