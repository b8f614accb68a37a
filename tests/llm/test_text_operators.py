"""Operators that keep one row for each document, against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.llm import bpe, fingerprints, language, line_dedup, packing, secrets
from tripwright.llm.vocabulary import BYTE_BPE, WORD_BPE, vocabulary


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def library(name):
    tokenizers = pytest.importorskip("tokenizers")
    out = tokenizers.Tokenizer.from_file(vocabulary(name))
    out.no_truncation()
    out.no_padding()
    return out


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_bpe_is_the_librarys(request, which):
    frame, tok = request.getfixturevalue(which), library(BYTE_BPE)
    want = []
    for i, t in frame.select("doc_id", "text").collect():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False)), ids))
    got = bpe.encode_documents(frame, vocabulary(BYTE_BPE))
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == sorted(want, key=repr)


def test_bpe_words_of_every_block():
    tok, own = library(BYTE_BPE), bpe.PairIndexBpe(vocabulary(BYTE_BPE))
    blocks = ["x" + " y".join(chr(c) for c in range(a, a + 40) if not 0xD800 <= c < 0xE000) for a in range(0, 0x3000, 40)]
    blocks += ["aaaaaaa" * 30, "\n\n  \t x", "ab" * 999]
    for text, ids in zip(blocks, own.encode(blocks), strict=True):
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == tok.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_packing_holds_each_id_once(request, which):
    frame, tok = request.getfixturevalue(which), library(WORD_BPE)
    ids = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in frame.select("doc_id", "text").collect()]
    pieces = packing.pack(frame, vocabulary(WORD_BPE)).collect()
    want = sorted((repr(i), at, len(x[at : at + 4096]), zlib.crc32(np.array(x[at : at + 4096], "<u4").tobytes()), len(x)) for i, x in ids for at in range(0, len(x), 4096))
    assert sorted((repr(p.doc_id), p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == want
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    if which == "docs":
        assert len(sequences) <= 1.03 * sum(len(x) for _, x in ids) / 4096 + 1


def test_a_batch_is_encoded_at_once():
    texts = [f"{k} " + "word " * 200 for k in range(3_000)]
    assert [len(x) for x in packing.stretches(texts)] == [3_000]
    assert [len(x) for x in packing.stretches(["a" * 3_000_000, "b" * 3_000_000, ""])] == [1, 2]


def test_a_text_is_cut_as_a_whole_and_a_part_merged_once(monkeypatch):
    class Counted:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def findall(self, text):
            self.calls += 1
            return self.inner.findall(text)

    tok, own = library(WORD_BPE), packing.WordIds(vocabulary(WORD_BPE))
    cut, merged, encode = Counted(packing.PARTS), [], own.bpe.encode_words
    monkeypatch.setattr(packing, "PARTS", cut)
    monkeypatch.setattr(own.bpe, "encode_words", lambda words: merged.extend(words) or encode(words))
    first = ["it's Straße, l'été 1234!", "don't we'LL\n\tx.y  o'clock 's't\xa0\x85\x0bÆ\xb5\xaa", ""]
    later = ["Été (it's) straße? l'x'clock.", "we'll... 21 'SX", "été \u0442\u0435\u0441\u0442\u2003don't e\u0301", "don't <|endoftext|>x", "y" * 60 + " o"]
    for texts in (first, later):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert cut.calls <= len(first) + 3
    assert len(merged) == len(set(merged))


def test_caches_of_parts_and_words_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PARTS", 6)
    monkeypatch.setattr(packing, "CACHE_WORDS", 4)
    tok, own = library(WORD_BPE), packing.WordIds(vocabulary(WORD_BPE))
    for k in range(3):
        texts = [f"{a}{'bcd'[k]}{b}, {a * 50}" for a in "xyz" for b in "uvw"] + [f"\u0436{a}{k} \u0436" for a in "abcdef"]
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(own.parts) <= 6 and len(own.words) <= 4 and max(map(len, own.parts)) <= packing.CACHE_LENGTH
        own.shrink()
        assert len(own.parts) + len(own.words) <= 4


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(5)
    histogram = dict(Counter(rng.integers(1, 4097, 20_000).tolist()) | {7: 90_000, 4096: 40})
    patterns = packing.shortest_pack_first(histogram)
    held = Counter()
    for p in patterns:
        assert sum(p.lengths) <= 4096
        held.update({k: n * p.count for k, n in Counter(p.lengths).items()})
    assert held == histogram
    assert packing.shortest_pack_first({}) == []


def plain_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    place = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(place(i))
    gone = lambda i, line: len(k := key(line)) >= min_chars and len(holders[k]) >= min_docs and place(i) != max(holders[k])
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not gone(i, x)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_line_dedup(request, which):
    frame = request.getfixturevalue(which)
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    got = line_dedup.summary(frame)
    assert rows_of(got, *got.columns) == plain_lines(rows)
    whole = line_dedup.drop_repeated(frame)
    assert whole.columns == frame.columns
    assert whole.count() == len(rows)


def test_line_runs_are_levelled_and_merged(spark):
    line = "a line that is long enough to count as one, number "
    frame = spark.createDataFrame([(k, f"{line}{k % 10}\n{line}x") for k in range(40)], "doc_id long, text string")
    runs = line_dedup.LevelledRuns(spark)
    lines = [line_dedup.lines_of(frame.where(f"doc_id % 9 = {k}"), "doc_id", "text", 40) for k in range(9)]
    for some in lines:
        runs.add(some)
    assert [len(level) for level in runs.levels] == [1, 2]
    assert rows_of(runs.keys(), "_docs") == [(4,)] * 10 + [(40,)]
    other = spark.createDataFrame([(99, f"{line}3\n{line}never seen")], "doc_id long, text string")
    assert line_dedup.fresh_lines(other, runs).count() == 1
    assert line_dedup.fresh_lines(other, runs).count() == 0


def plain_secrets(text):
    found = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_secrets_base(request, which):
    frame = request.getfixturevalue(which)
    want = []
    for i, t in frame.select("doc_id", "text").collect():
        found = plain_secrets(t or "")
        want.append((i, *(sum(k == x for k, _, _ in found) for x in ("assign", "access", "hex")), sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))))
    got = secrets.scan(frame)
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)


def test_secrets_link_parts_in_scope():
    access, value, place = "AKIA" + "Q" * 16, "abcdefghij" * 4, "https://api.example.com"
    alone = f"{value} and {place}"
    assert secrets.all_spans(alone)[1] == []
    both = f"id {access} with {value} at {place}"
    assert [k for k, _, _ in secrets.all_spans(both)[1]] == ["access", "linked", "endpoint"]
    assert both[secrets.all_spans(both)[1][1][1] :].startswith(value)
    far = access + " ." * 400 + value
    assert [k for k, _, _ in secrets.all_spans(far)[1]] == ["access"]
    assert secrets.redacted(both) == "id [SECRET] with [SECRET] at [SECRET]"
    assert secrets.redacted("") == ""


@pytest.mark.parametrize("before", ["aws_secret_access_key=", "aws_secret_access_key = ", "?a=", "&sig=", "k==", "key: '"])
def test_secrets_link_values_after_a_name(before):
    access, value, place = "AKIA" + "Q" * 16, "abcdefghij" * 4, "https://api.example.com"
    text = f"aws_access_key_id={access}\n{before}{value}\nendpoint={place}"
    found = secrets.all_spans(text)[1]
    assert [(k, text[a:b]) for k, a, b in found if k != "endpoint"] == [("access", access), ("linked", value)]
    assert [text[a:b] for k, a, b in found if k == "endpoint"] == [place]
    assert secrets.redacted(text) == f"aws_access_key_id=[SECRET]\n{before}[SECRET]\nendpoint=[SECRET]"
    assert secrets.all_spans(f"{before}{value}")[1] == []


def test_values_inside_other_spans_are_not_linked_again():
    access, value = "AKIA" + "Q" * 16, "Zbcdefghij" * 4
    text = f"{access} token={'0' * 24}={'1' * 24}={value}"
    assert sorted(k for k, _, _ in secrets.all_spans(text)[1]) == ["access", "assign", "hex", "hex"]
    assert [k for k, _, _ in secrets.all_spans(f"{access} k={value}=")[1]] == ["access"]


def test_redact_keeps_rows(odd):
    out = secrets.redact(odd)
    assert out.columns == odd.columns
    assert out.where("doc_id = 14").first()["text"] == "[SECRET] [SECRET]"
    assert out.where("text is null").count() == odd.where("text is null").count()


def test_language_on_rows_not_learned(docs, sf_dir, spark):
    frame = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = language.identify(frame, language.trained(frame)).join(frame.select("doc_id", "lang"), "doc_id").collect()
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found} == {True}
    apart = [r for r in found if r.held_out and r.lang]
    assert np.mean([r.lang_pred == r.lang for r in apart]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_cases(odd, none):
    model = language.trained(odd)
    found = {r.doc_id: r for r in language.identify(odd, model).collect() if r.doc_id}
    assert [found[i].lang_pred for i in (4, 5, 6, 16)] == ["und"] * 4
    assert found[4].score == 0
    assert found[1].lang_pred in ("de", "en")
    assert language.identify(none, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.trained(none)).collect()} == {"und"}
    assert language.tagged(odd, model).select("row.*").columns == odd.columns


def test_a_filter_on_language_predicts_once(odd):
    found = language.tagged(odd, language.trained(odd)).where(F.col("lang") != language.UNKNOWN)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_code_words_lie_apart():
    for classes in (2, 3, 4, 5, 9, 40):
        code = language.code_matrix(classes)
        apart = min((code[a] != code[b]).sum() for a in range(classes) for b in range(a))
        assert apart >= (1 if classes == 2 else 2)


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
@pytest.mark.parametrize("range_bytes", [4 << 20, 20_000])
def test_fingerprints_and_next_rows(request, which, range_bytes):
    frame = request.getfixturevalue(which)
    rows = sorted(((-(2**63) if i is None else i, t or "", i) for i, t in frame.select("doc_id", "text").collect()), key=lambda r: r[:2])
    want = []
    for k, (_, t, i) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        want.append((i, len(t), sha(t[: len(t) - half] + after[:half]), len(re.match("", t)[0])))
    got = fingerprints.fingerprint_documents(frame, range_bytes=range_bytes)
    assert rows_of(got, "doc_id", "n_chars", "edited_sha256") == sorted((w[:3] for w in want), key=repr)
    marks = defaultdict(set)
    for r in got.collect():
        marks[r.doc_id].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    same = defaultdict(set)
    for _, t, i in rows:
        same[t].update(marks[i] if sum(x[2] == i for x in rows) == 1 else ())
    assert all(len(x) <= 1 for x in same.values())


def test_prefix_hashes_answer_spans():
    text = "abracadabra, abracadabra. " * 40
    own, other = (fingerprints.PrefixHashes(fingerprints.code_points(t)) for t in (text, "x" + text[:500] + "?" + text[500:]))
    assert own.common_extension(0, 1, other) == 500
    assert own.common_extension(0, 13) == 11
    assert own.spans_equal(0, 13, 11) and not own.spans_equal(0, 13, 12)
    assert fingerprints.PrefixHashes(fingerprints.code_points("")).common_extension(0, 0, own) == 0
