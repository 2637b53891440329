"""Token files and packing against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from colonnade.llm import cost_packing, token_files, tokens
from colonnade.session import BATCH_ROWS, scratch_path
from tests.llm.conftest import EDGE

VOCAB = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCAB)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ODD = ["a  b", "a\n\nb", "a\n b", "a \nb", "\na", "a\n", "a\tb", "it's  don't", "x　y", "<|endoftext|> a", "1 2x1 \U0001f600é", "a\x00b", "x\x1fy z",
       "foo. bar, ab.' x's. .foo", "a.\nb", "“q”. «x»!? c", "ab(c) d[e]", "'tis 'll we'll", "é́x", " lead", "trail "]


def test_encoder_equals_library(library, small):
    enc = tokens.PieceEncoder(VOCAB, cache_pieces=500)
    texts = [t for _, t in EDGE] + ODD + [t for _, t in small[1]]
    assert [x.tolist() for x in enc.encode(texts)] == [library(t) for t in texts]
    assert [x.tolist() for x in enc.encode(ODD)] == [library(t) for t in ODD]


def test_encoder_works_in_bounded_steps(library, monkeypatch):
    """Texts are cut and looked up in runs of bounded size and new pieces encoded in calls of bounded size."""
    monkeypatch.setattr(tokens, "TEXT_BYTES", 4000)
    monkeypatch.setattr(tokens, "CALL", 2)
    runs, calls = [], []
    enc = tokens.PieceEncoder(VOCAB, cache_pieces=300)
    whole, each = enc.encode_regular, enc.run_ids
    monkeypatch.setattr(enc, "encode_regular", lambda raw, off: runs.append(len(raw)) or whole(raw, off))
    monkeypatch.setattr(enc, "run_ids", lambda run: calls.append(len(run)) or each(run))
    texts = [" ".join(f"w{i * j % 977}" for j in range(1, 120)) for i in range(1, 60)] + ["x" * 5000, None, "", " odd  text"]
    assert [x.tolist() for x in enc.encode(texts)] == [library(t) for t in texts]
    assert max(runs) <= 5000 and sum(n > 4000 for n in runs) <= 2 and max(calls) <= 2
    assert len(enc.keys) <= 300 + 4000


def test_full_cache_keeps_what_came_again(library, monkeypatch):
    """Pieces that come in every run are encoded once, however often the cache is full of others."""
    enc = tokens.PieceEncoder(VOCAB, cache_pieces=200)
    encoded, real = [], enc.new_ids
    monkeypatch.setattr(enc, "new_ids", lambda new: encoded.extend(new) or real(new))
    common = " ".join(f"Common{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} n{i}." for i in range(40))
    texts = [common + "".join(f" once{i}x{j}" for j in range(30)) for i in range(60)]
    assert [enc.encode([t])[0].tolist() for t in texts] == [library(t) for t in texts]
    assert [encoded.count(p) for p in common.encode().replace(b" ", b"\0 ").split(b"\0")] == [1] * 80
    assert len(encoded) == 80 + 60 * 30 and len(enc.keys) <= 200 + 30
    # more of them than may stay: still right, and bounded
    enc = tokens.PieceEncoder(VOCAB, cache_pieces=40)
    for t in texts + texts[:3]:
        assert enc.encode([t])[0].tolist() == library(t) and len(enc.keys) <= 40 + 110


def test_letters_pass_the_pattern(library, monkeypatch):
    """Pieces of letters go to the merges at once; any others, and letters of other scripts, through the pattern."""
    enc = tokens.PieceEncoder(VOCAB)
    through, real = [], enc.run_ids
    monkeypatch.setattr(enc, "run_ids", lambda runs: through.extend(runs) or real(runs))
    plain = ["Words of\nletters", "größe naïve façade", "Łódź Ðuro ǅemper ȿ", "x" * 700]
    assert [x.tolist() for x in enc.encode(plain)] == [library(t) for t in plain]
    assert through == ["."]  # in place of the line feed
    odd = [f"a{chr(c)}b {chr(c)}{chr(c)} {chr(c)}c1" for c in range(0x80, 0x2C0)] + ["3×4 a×b ×÷ x÷y", "д东京 ёж 한국", "a1b2 'tis it's we'll"]
    assert [x.tolist() for x in enc.encode(odd)] == [library(t) for t in odd]
    assert [enc.encode([t])[0].tolist() for t in odd] == [library(t) for t in odd]
    assert any("×" in r for r in through) and any("东京" in r for r in through)


def test_other_patterns_cut_words(tmp_path):
    """Words go past the pattern only where it is known to leave them whole."""
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    t = Tokenizer.from_file(VOCAB)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"e|\n| ?[^e \n]+"), "isolated"), pre_tokenizers.ByteLevel(False, use_regex=False)])
    t.save(str(tmp_path / "t.json"))
    enc = tokens.PieceEncoder(str(tmp_path / "t.json"))
    texts = ["there were seven", "one\ntree here"]
    assert [x.tolist() for x in enc.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert enc.encode(["there"])[0].tolist() != tokens.PieceEncoder(VOCAB).encode(["there"])[0].tolist()


def test_packing_gets_small_batches(spark, monkeypatch):
    """A worker holds a bounded number of whole texts at a time, and the session's setting is as before."""
    monkeypatch.setattr(cost_packing, "TEXTS", 7)
    seen, real = [], cost_packing.materialize
    monkeypatch.setattr(cost_packing, "materialize", lambda df, name: seen.append(spark.conf.get(BATCH_ROWS)) or real(df, name))
    before = spark.conf.get(BATCH_ROWS)
    docs = spark.createDataFrame([(i, "a b " * i) for i in range(40)], "doc_id long, text string")
    assert cost_packing.pack(docs, VOCAB, 64).agg({"length": "sum"}).first()[0] > 40
    assert seen == ["7"] and spark.conf.get(BATCH_ROWS) == before


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 10_001).astype(np.uint32)
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), len(ids), bits) == ids).all()
    docs = np.split(ids, [5, 5, 4096, 9000])
    f = token_files.TokenFile(token_files.build_segment([3, None, 1, 7, 9], docs, bits))
    assert f.ids(0, f.n_ids).tolist() == ids.tolist()
    assert f.ids(4090, 8200).tolist() == ids[4090:8200].tolist()
    assert f.ids(77, 77).tolist() == []
    assert all(f.doc(k).tolist() == d.tolist() for k, d in enumerate(docs))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, edge, empty, library):
    path = scratch_path(spark, "t")
    token_files.write_token_files(edge, path, VOCAB, segment_ids=500)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_token_files(spark, path).collect()))
    rows = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for d, t in rows:
        ids = library(t) + [0]
        want.append((at, d, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    path = scratch_path(spark, "t")
    token_files.write_token_files(empty, path, VOCAB)
    assert token_files.read_token_files(spark, path).count() == 0


def check_packing(pieces, rows, library, length):
    """Every id once and in order, sequences gapless and within the length; returns the lengths of short ones."""
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(library(t) + [1])
    have = defaultdict(int)
    for p in pieces:
        found = [w for w in want[p["doc_id"]] if len(w) == p["doc_tokens"] and crc(w[p["start"]:p["start"] + p["length"]]) == p["ids_crc32"]]
        assert found and p["length"] > 0
        have[p["doc_id"]] += p["length"]
    assert dict(have) == {d: sum(map(len, w)) for d, w in want.items()}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    total = []
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
        total.append(at)
    return [n for n in total if n < length]


@pytest.mark.parametrize("length,group", [(2048, 1 << 20), (64, 500), (7, 100)])
def test_packing(edge, empty, library, length, group):
    pieces = cost_packing.pack(edge, VOCAB, length, group_tokens=group).collect()
    assert len(check_packing(pieces, EDGE, library, length)) <= 1
    assert cost_packing.pack(empty, VOCAB, length).count() == 0


def test_packing_ids(edge):
    rows = cost_packing.pack(edge, VOCAB, 64, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)


def test_packing_balances_cost():
    """Documents are whole where they fit, and no sequence has all the long ones."""
    rng = np.random.default_rng(1)
    items = [cost_packing.Item(i, 0, np.zeros(n, np.uint32), n) for i, n in enumerate(rng.integers(1, 1500, 400))]
    sequences, rest = cost_packing.pack_group(items, 2048, False)
    cost = [sum(len(p.ids) + len(p.ids) ** 2 / 1024 for p in s) for s in sequences]
    assert all(sum(len(p.ids) for p in s) == 2048 for s in sequences) and sum(len(p.ids) for p in rest) < 2048
    assert max(cost) < 2.2 * min(cost)
    pieces = sum(len(s) for s in sequences) + len(rest)
    assert pieces <= 400 + len(sequences)
