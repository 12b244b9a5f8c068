"""Hard negatives, token alignment and token counts against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tabsmith.llm import op11_hard_negatives as op11
from tabsmith.llm import op12_alignment as op12
from tabsmith.llm import op13_token_counts as op13
from tabsmith.llm.chunk_memo import ChunkMemo, piece_starts, text_runs, word_starts
from tabsmith.llm.common import model_path, tokenizer_path

ODD = ["a", "b", " ", "\n", "▁", "é", "日", "\t", " ", "  ", "the", " of", "　", "🎉", "'s", "123", "\x85", "\x1d",
       " word", "  \n ", "\x00", "</s>", "<unk>", "<|endoftext|>", "<0x0A>"]
WEIGHTS = [3, 3, 6, 2, .02, 1, 1, .5, 3, 1, 5, 5, .3, .5, 1, 1, .2, .2, 5, .5, .1, .1, .1, .1, .1]
#: Cases by name: null, empty, blank, very long without a place to cut, control strings.
PLAIN = [None, "", " ", "  ", "\n", "\n\n a", "x ", "▁", "▁▁ x ▁", "a\x00 b\x00\x00", "aaaa" * 300, "tab\tx  \t y   z",
         "</s> <unk> <|endoftext|>", " " * 70 + "x", "é " * 90, "日本語" * 60]


def odd_texts(n, seed):
    r = random.Random(seed)
    return PLAIN + ["".join(r.choices(ODD, WEIGHTS, k=r.randint(0, 120))) for _ in range(n)]


# --- 13: counts ---------------------------------------------------------------------------------------------------

def library_count(texts):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    return [len(model.encode(t)) if t else 0 for t in texts]


def test_counts_are_the_library_s():
    texts = odd_texts(4000, 3)
    counter = op13.TokenCounter(model_path(), most=500)          # starts anew many times
    assert counter.ranks.cuts
    assert counter.count(pa.array(texts)).tolist() == library_count(texts)


def test_counts_without_cuts_and_of_a_very_long_text():
    texts = ["word " * 3000 + "x" * 50_000 + "\n" + "日本" * 5000, "a  b", ""]
    counter = op13.TokenCounter(model_path())
    assert counter.count(pa.array(texts)).tolist() == library_count(texts)
    counter.ranks.cuts = False
    counter.memo.restart()
    assert counter.count(pa.array(texts)).tolist() == library_count(texts)


def test_merges_are_popped_by_rank_then_place():
    ranks = op13.PieceRanks.__new__(op13.PieceRanks)
    ranks.rank = {"a": 9, "b": 9, "ab": 2, "ba": 1, "aa": 1}
    assert ranks.count("abab") == 3          # ba first: a, ba, b
    ranks.rank["aba"] = 0
    assert ranks.count("abab") == 2          # which makes a pair of its own
    assert ranks.count("aaa") == 2           # the leftmost of equal pairs
    assert ranks.count("aé") == 3            # no piece: its bytes


def test_count_query_shape(spark):
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, None, 7), (2, "w " * 5000, 8)],
                               "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, op13.count_tokens(df, model_path()).collect()), key=str)
    n = library_count(["a b", "w " * 5000])
    assert got == sorted([(1, 3, n[0], False), (1, 3, n[0], False), (None, 0, 0, False), (2, 10_000, n[1], True)], key=str)
    assert op13.count_tokens(df.limit(0), model_path()).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert op13.count_tokens(df.limit(0), model_path()).count() == 0


# --- the memory of chunks -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("most", [3, 40, 10_000])
def test_memo_numbers_tell_chunks_apart(most):
    known = []
    memo = ChunkMemo(lambda new: known.extend(new), known.clear, most)
    for cut in (word_starts, piece_starts):
        for first, data, offsets in text_runs(pa.array(odd_texts(300, 5)), 2000):
            starts = cut(data, offsets)
            ends = np.append(starts[1:], len(data))
            chunks = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            assert [known[i] for i in memo.find(data, starts)] == chunks
    assert len(set(known)) == len(known)


def test_memo_survives_a_shared_mix(monkeypatch):
    known = []
    memo = ChunkMemo(lambda new: known.extend(new), known.clear, 1000)
    real, calls = memo._mixed, []

    def weak(keys):
        calls.append(1)
        return real(keys) & np.uint64(3) if memo.salt == 0 else real(keys)

    monkeypatch.setattr(memo, "_mixed", weak)
    data = np.frombuffer(b" a b c d e f g", np.uint8)
    starts = np.flatnonzero(data == 32)
    assert [known[i] for i in memo.find(data, starts)] == [b" a", b" b", b" c", b" d", b" e", b" f", b" g"]
    assert memo.salt == 1 and len(calls) == 2


# --- 12: alignment ------------------------------------------------------------------------------------------------

def brute_alignment(docs):
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel
    a_model = Tokenizer.from_file(tokenizer_path())
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    table = op12.Tokenizers(tokenizer_path(), model_path()).bytes_a

    def bytes_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    for i in (0, 100, 5000, 40_000):         # the bytes of A's entries, where they are whole characters
        assert ByteLevel().decode([a_model.id_to_token(i)]) == table[i].decode("utf-8", "replace")
    rows, links, counts = [], [], collections.Counter()
    for _, text in docs:
        groups, own, n_a, n_b = [], [], 0, 0
        if text:
            whole = (" " + text).encode()
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            parts = [[table[i] for i in a], [bytes_b(i) for i in b]]
            if b"".join(parts[0]) == whole == b"".join(parts[1]):
                ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
                n_a, n_b, x, y = len(a), len(b), 0, 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    i, j = ends[0].index(end) + 1, ends[1].index(end) + 1
                    groups.append(f"{','.join(map(str, a[x:i]))}|{','.join(map(str, b[y:j]))}")
                    own.append((a[i - 1], b[j - 1]))
                    x, y = i, j
        rows.append((n_a, n_b, len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        links.append(own)
        counts.update(own)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted([(doc[0], *row[:3], len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), row[3])
                   for doc, row, own in zip(docs, rows, links, strict=True)], key=str)


@pytest.mark.parametrize("range_bytes, max_pairs", [(32768, 2_000_000), (16, 2_000_000), (50, 60)])
def test_alignment_is_brute_force(spark, range_bytes, max_pairs):
    texts = odd_texts(120, 11)
    docs = [(None if i % 40 == 7 else i, t) for i, t in enumerate(texts)]
    docs += [docs[30], docs[30], (30, "another text of one id"), (31, "the same"), (32, "the same")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, key int")
    got = op12.align(df, tokenizer_path(), model_path(), range_bytes=range_bytes, max_pairs=max_pairs)
    assert sorted(map(tuple, got.collect()), key=str) == brute_alignment(docs)


def test_alignment_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op12.align(df, tokenizer_path(), model_path()).count() == 0


def random_tokens(r, ends):
    return op12.Tokens(np.array([r.randint(0, 99) for _ in ends], np.int64), np.array(ends, np.int64))


def test_fragments_compose_to_the_whole_in_any_order():
    """Associative: every binary tree over the ranges gives the groups of the whole."""
    r = random.Random(5)
    for _ in range(300):
        size = r.randint(1, 60)
        ends = [sorted({size, *r.sample(range(1, size + 1), r.randint(0, size // r.randint(1, 6)))}) for _ in range(2)]
        a, b = (random_tokens(r, e) for e in ends)
        cuts = sorted({0, size, *r.sample(range(size + 1), min(size, r.randint(0, 6)))})
        parts = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            # A and B need not be cut at one place: the token over a cut may be on either side.
            own = [t.part(*np.searchsorted(t.ends, [low, high], side="right")) for t in (a, b)]
            part = op12.fragment(*own)
            parts.append((part, [(part, part.closed)] if part.closed is not None else []))
        while len(parts) > 1:
            i = r.randrange(len(parts) - 1)
            (left, told_left), (right, told_right) = parts[i], parts[i + 1]
            whole, closed = op12.compose(left, right)
            parts[i:i + 2] = [(whole, [*told_left, (None, closed), *told_right])]
        (whole, told), = parts
        text = op12.close(*whole.prefix).text + b"".join(g.text for _, g in told)
        assert text == op12.close(a, b).text
        assert not len(whole.suffix[0].ids) and not len(whole.suffix[1].ids)
        empty_left, closed = op12.compose(op12.EMPTY, whole)
        assert not closed.n_a and op12._pack(empty_left.prefix) == op12._pack(whole.prefix)


# --- 11: hard negatives -------------------------------------------------------------------------------------------

def brute_negatives(rows, every=3):
    """Exact whole-number version of the contract."""
    clean = []
    for id_, vector, label in rows:
        if None in (id_, label, vector) or any(x is None or x != x or abs(x) == float("inf") for x in vector):
            continue
        whole = [min(max(int(np.floor(x * 256.0)) if abs(x * 256.0) != float("inf") else (1 if x > 0 else -1) << 70, -2**63), 2**63 - 1)
                 for x in vector]
        clean.append((id_, (label + 1) % 10 if id_ % 7 == 0 else label, tuple(whole)))
    out = []
    for id_, label, own in set(clean):
        if id_ % every:
            continue
        scored = [(min(max(sum(a * b for a, b in zip(own, v)), -2**63), 2**63 - 1), i, same == label)
                  for i, same, v in clean if i != id_ and len(v) == len(own)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 50 * score <= 100 * s[0] <= 95 * score][:3]
            out += [(id_, positive, k, i, score, s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every=3):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, id int")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, op11.mine(df, F.col("id") % every == 0, moved).collect()))


def test_negatives_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op11, "BLOCK", 40)
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=6) + (i % 4)).tolist(), i % 4) for i in range(160)]
    rows += [(200 + i, [1.0] * 6, i % 2) for i in range(30)]                    # ties
    rows += [rows[9], rows[9], (9, [2.0] * 6, 1), (12, [2.0] * 6, 1)]           # repeated ids, repeated rows
    rows += [(300, [0.0] * 6, 1), (303, [1.0, 2.0], 1), (304, [2.0, 1.5], 2), (306, [2.0, 1.5], 1), (309, [], 1), (312, [], 2)]
    rows += [(None, [1.0] * 6, 1), (330, None, 1), (333, [1.0] * 6, None), (336, [1.0, None] * 3, 1),
             (339, [1.0, float("nan")] * 3, 1), (342, [float("inf")] * 6, 1)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_very_large_components(spark):
    rows = [(3 * i, [v, 1e9, -v], i % 2) for i, v in enumerate([1e300, 1e200, 1e12, 3e7, 1e9, 2.5, -1e300, 1e10])]
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_an_empty_table(spark):
    assert mined(spark, []) == []


def test_threshold_stops_early_and_keeps_ties():
    r = np.random.default_rng(1)
    vectors = r.integers(-50, 50, size=(4000, 3))
    vectors[2000:2010] = [60, 60, 60]
    ids = np.arange(4000)
    block = op11.Block(ids, np.zeros(4000, np.int64), vectors, np.argsort(vectors, axis=0, kind="stable").T)
    window = op11.Best(4)
    scored = op11.threshold_search(block, np.array([2, 1, 3]), np.ones(4000, bool), [window])
    assert window.ids == [2000, 2001, 2002, 2003] and window.scores == [360] * 4
    assert scored < 2000
    bounded = op11.Best(3, 100, 200)
    op11.threshold_search(block, np.array([2, 1, 3]), np.ones(4000, bool), [bounded])
    scores = vectors @ [2, 1, 3]
    want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if 100 <= s <= 200)[:3]
    assert [(-s, i) for s, i in zip(bounded.scores, bounded.ids)] == want
