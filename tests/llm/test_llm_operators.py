"""Edge cases and brute-force checks of the training-data operators."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm import (components, op1_license, op2_line_crf, op3_decontaminate, op4_chat, op5_token_files,
                          op6_jaccard_join, op7_mix, op8_url_filter, op9_html, op10_neighbours)
from tabsmith.llm.common import ASCII_LOWER, tokenizer_path

# Columns that clash with names the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, id long, h string, node int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, 1, 2, "x", 3) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    out = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    for i in range(40, 90):                              # near and exact copies
        words = base[i % 12].split()
        for _ in range(rng.randint(0, 2)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append((i, " ".join(words).upper() if i % 7 == 0 else " \n".join(words), None if i % 5 else "s1"))
    long = " ".join(rng.choice(vocab) for _ in range(30_000))
    return [*out, (90, None, "s0"), (91, "", "s2"), (92, "one two", None), (93, "ONE\ttwo ", "s0"), (94, long, "s1"), (94, long, "s1"),
            (95, "  ", "s1"), (None, "no id at all here but words", "s1"), (96, "é 漢字 <|endoftext|> a   b\n\n c", "s2")]


def brute_components(rows):
    sets = {}
    for i, t, _ in rows:
        if i is not None:
            w = WORD.findall((t or "").translate(ASCII_LOWER))
            sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    near = {i: {j for j in sets if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in sets}
    out = {}
    for i in sorted(sets):
        if i not in out:
            todo, seen = [i], {i}
            while todo:
                fresh = near[todo.pop()] - seen
                seen |= fresh
                todo += fresh
            out |= {j: i for j in seen}
    return {i: (len(sets[i]), out[i]) for i in sets}


@pytest.mark.parametrize("short_list, block", [(32, 8192), (2, 8192), (2, 5)])
def test_jaccard_components_are_brute_force(spark, texts, monkeypatch, short_list, block):
    monkeypatch.setattr(op6_jaccard_join, "SHORT_LIST", short_list)
    monkeypatch.setattr(op6_jaccard_join, "BLOCK_DOCS", block)
    got = op6_jaccard_join.jaccard_join(docs(spark, texts)).collect()
    assert len(got) == len(texts)
    want = brute_components(texts)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    kept = op6_jaccard_join.keep_one(docs(spark, texts)).select("doc_id").collect()
    assert {r.doc_id for r in kept} - {None} == {c for _, c in want.values()}


@pytest.mark.parametrize("edges", [
    [], [(3, 3), (None, 4), (5, None)], [(1, 0)] * 3,
    [(i, i + 1) for i in range(200)],                                   # a path
    [(100, i) for i in range(200)],                                     # a star around a middle node
    [(i * 7919 % 400, i * 104729 % 397) for i in range(350)] + [(-9, 399), (2**62, -(2**62))]])
def test_components_are_union_find(spark, edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    got = components.connected_components(frame).collect()
    assert sorted((r["node"], r["component"]) for r in got) == sorted((x, find(x)) for x in root)


def test_divide_skip_uses_both_kinds_of_lists():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = []
    for _ in range(150):
        own = base.copy()
        own[rng.integers(0, 200, rng.integers(0, 60))] = rng.integers(0, 1 << 60)
        sets.append(np.unique(own))
    links = op6_jaccard_join.divide_skip(sets)
    parent = list(range(150))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in links:
        o = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o)
        parent[root(i)] = root(j)
    for i in range(150):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                assert root(i) == root(j)


def test_token_files_round_trip(spark, texts):
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(tokenizer_path()).encode
    manifest = op5_token_files.write_token_files(docs(spark, texts), tokenizer_path())
    got = op5_token_files.read_token_files(manifest, with_ids=True).orderBy("start").collect()
    want = {i: encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in texts}
    assert len(got) == len(texts) and [r.doc_id for r in got[1:]] == sorted(i for i, _, _ in texts if i is not None)
    at = 0
    for r in got:
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.n_tokens == len(want[r.doc_id])
        at += r.n_tokens
    some = op5_token_files.read_token_files(manifest, wanted=[3, 94, 1000]).collect()
    assert sorted(r.doc_id for r in some) == [3, 94, 94]
    path = manifest.head().path
    store, name = op5_token_files.open_store(path)
    raw = bytearray(store.open_input_file(name).read())
    raw[10] ^= 255
    import pyarrow as pa
    with pytest.raises(Exception):
        reader = op5_token_files.ShardReader(pa.BufferReader(bytes(raw)))
        [reader.ids(i) for i in range(len(reader))]


def test_mix_meets_budgets(spark, texts):
    got = op7_mix.mix(docs(spark, texts)).collect()
    assert len(got) == len(texts)
    size = {}
    for _, t, s in texts:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    assert sum({(r.source_size, r.target) for r in got}.__len__() for _ in [0]) <= len(size)
    assert abs(sum(t for _, t in {(r.source_size, r.target) for r in got}) - 1.5 * sum(size.values())) < 1e-6
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 2             # equal rows share what is left evenly
    mixed = op7_mix.apply_mix(docs(spark, texts), length_col="n_chars")
    assert mixed.columns == docs(spark, texts).columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert {k: v for k, v in taken.items() if v} == words


def test_chat_round_trip_with_parts(spark):
    odd = ["</s>[INST] ok [/INST]", "<|end|><\\|end|>", "[\\INST]<\\\\|x", "", None, "<s>é\n漢 <|text|>"]
    rows = [(c, t, ["user", "assistant", None][t % 3], odd[(c + t) % 6]) for c in range(4) for t in range(130)] + [(None, None, "user", "x")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = F.concat(op4_chat.text_part(F.col("text")), F.array(F.struct(
        F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("a.png").alias("ref"), F.lit(57).alias("width"),
        F.lit(28).alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))))
    made = op4_chat.format_conversations(df.withColumn("parts", F.when(F.col("turn") == 0, parts).otherwise(op4_chat.text_part(F.col("text")))))
    for r in made.collect():
        n = 0 if r.conv_id is None else 1
        assert [(a.type, a.ref, a.n_tokens) for a in r.attachments] == [("image", "a.png", 3)] * n
        at, lost = 0, []
        for run in r["mask"]:
            if run.loss:
                lost.append(r.formatted[at:at + run.n])
            at += run.n
        assert at == len(r.formatted)
        back = "".join(re.sub(r"(<|\[)\\(\\*)(\||/?s>|/?INST\])", r"\1\2\3", x) for x in lost)
        want = [(t or -1, ro or "", x or "") for c, t, ro, x in rows if c == r.conv_id]
        assert back == "".join(x for _, ro, x in want if ro == "assistant")
    plain = op4_chat.digest(op4_chat.format_conversations(df.withColumn("parts", op4_chat.text_part(F.col("text"))))).collect()
    for r in plain:
        mine = [(ro or "", x or "") for c, _, ro, x in rows if c == r.conv_id]
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()


def test_cascade_is_exact_over_its_universe(spark):
    hosts = [f"h{i}.example{i % 7}.org" for i in range(4000)]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)] + [(-1, None), (-2, "no scheme"), (-3, "x://A.B?q")],
                                  "page_id long, url string")
    listed = spark.createDataFrame([(h,) for h in hosts[::9]] + [(None,), ("",), (hosts[0],)], "host string")
    want = {i: "block" if h in set(hosts[::9]) else "allow" for i, h in enumerate(hosts)}
    for bits in (op8_url_filter.MAX_BITS, 64):          # cascade, then the join beyond its bound
        got = {r.page_id: r for r in op8_url_filter.filter_urls(pages, (), listed, keep=["page_id"], max_bits=bits).collect()}
        assert {i: got[i].verdict for i in want} == want
        assert (got[-1].host, got[-1].path, got[-3].host, got[-3].path) == ("", "", "a.b", "")
    keys = spark.createDataFrame([(h, i % 9 == 0) for i, h in enumerate(hosts)], "key string, listed boolean")
    assert len(op8_url_filter.build_cascade(keys)) > 1


def test_leaks_are_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40))) for _ in range(25)] + [None, "", "..."]
    rows = []
    for i in range(60):
        words = items[i % 25].split()
        for _ in range(int(0.2 * len(words)) + (i % 2)):
            p, k = rng.randrange(len(words) or 1), rng.random()
            words = words[:p] + ([] if k < .3 else [rng.choice(vocab)]) + words[p + (k < .7):]
        rows.append((i, " ".join([rng.choice(vocab) for _ in range(20)] + words + ["z"] * 9), "s"))
    rows += [(60, None, "s"), (61, "", "s"), (62, "w1", "s")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in op3_decontaminate.find_leaks(docs(spark, rows), bench).collect()}

    def least(a, b):
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
        return min(row)
    want = {}
    for d, t, _ in rows:
        for i, item in enumerate(items):
            a = re.findall(r"[a-z0-9]+", item or "")
            most = int(0.2 * len(a)) if len(a) >= 3 else 0
            if a and (e := least(a, re.findall(r"[a-z0-9]+", t or ""))) <= most:
                want[d, i] = e
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.99 * len(want)
    clean = op3_decontaminate.drop_leaks(docs(spark, rows), bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _, _ in rows} - {d for d, _ in got}


@pytest.mark.parametrize("edit", ["change", "insert", "delete"])
@pytest.mark.parametrize("size", [5, 14, 59, 200, 1000])
def test_no_leak_is_lost_at_most_edits(size, edit):
    rng = np.random.default_rng(size)
    items = list(rng.integers(1, 2**63, (8, size)).astype(np.uint64))
    texts = []
    for item in items:
        at = rng.choice(size, size // 5, replace=False)
        fresh = rng.integers(1, 2**63, len(at)).astype(np.uint64)
        run = item.copy()
        run[at] = fresh
        run = {"change": run, "insert": np.insert(item, at, fresh), "delete": np.delete(item, at)}[edit]
        texts.append(np.concatenate([rng.integers(1, 2**63, 20).astype(np.uint64), run]))
    index = op3_decontaminate.Index(list(range(len(items))), items)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = index.leaks(np.concatenate(texts), offsets)
    assert set(found) == {(i, i) for i in range(len(items))}
    assert not index.leaks(rng.integers(1, 2**63, 5000).astype(np.uint64), np.array([0, 5000]))


def test_neighbours_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op10_neighbours, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(op10_neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    v = {i: rng.normal(size=8).round(3).tolist() for i in range(300)}
    v |= {i: v[0] for i in range(300, 340)}              # ties
    bad = {400: None, 401: [0.0] * 8, 402: [float("nan")] * 8, 403: [None] * 8, 404: [1.0, 2.0], 405: []}
    df = spark.createDataFrame([(i, x, "l") for i, x in {**v, **bad}.items()], "vec_id long, embedding array<double>, q string")
    got = op10_neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    want = []
    for q in [i for i in v if i % 20 == 0]:
        s = sorted((-float((np.array(v[q]) * np.array(x)).sum()), i) for i, x in v.items() if i != q)[:20]
        want += [(q, n, i) for n, (_, i) in enumerate(s, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(want)


def test_neighbours_of_every_length_and_repeated_id(spark, monkeypatch):
    monkeypatch.setattr(op10_neighbours, "CANDIDATE_BLOCK", 20)
    monkeypatch.setattr(op10_neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=d).round(3).tolist()) for d, n in ((8, 90), (5, 40), (3, 1)) for i in rng.integers(0, 60, n)]
    rows += [(20, rows[0][1])] * 30 + [(7, rows[1][1])] * 30               # equal rows of one id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = op10_neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    want = []
    for q in (0, 20, 40):
        pairs = sorted((-float((np.array(x) * np.array(y)).sum()), j) for i, x in rows if i == q
                       for j, y in rows if j != q and len(x) == len(y))[:20]
        want += [(q, n, j, round(-s, 9)) for n, (s, j) in enumerate(pairs, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(want)


def test_licenses_in_text(spark):
    filler = "lorem ipsum dolor sit amet " * 30
    mit = op1_license.TEMPLATES["MIT-permission"]
    rows = [(1, filler + "Released under the MIT License.\n" + filler, "s"), (2, mit.upper().replace(" ", "\n * "), "s"),
            (3, filler, "s"), (4, None, "s"), (5, "", "s"), (6, " ".join(mit.split()[:30]), "s"), (1, "x", "s"),
            (7, mit.replace("merge", "fuse"), "s")]
    got = {(r.doc_id, r.license): r for r in op1_license.scan_licenses(docs(spark, rows)).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT-permission"), (7, "MIT-permission")}
    assert got[1, "MIT"].first_word == 150 and got[2, "MIT-permission"].containment == 1.0


def test_quality_on_made_lines(spark):
    rng = random.Random(4)
    def line(good):
        w = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(3, 15))]
        return " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w)
    rows = [(i, "\n".join(line(i % 3 > 0) for _ in range(rng.randint(1, 8))), "s") for i in range(400)] + [(900, None, "s"), (901, "", "s"), (902, "x" * 200_000, "s")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "z") for i in range(400)] + [(5, 1, "z"), (None, 1, "z"), (6, None, "z")], "doc_id long, quality int, text string")
    model = op2_line_crf.fit(docs(spark, rows), labels)
    got = op2_line_crf.score(docs(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert held and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_fits_take_one_row_of_an_id_and_bounded_lines(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(op2_line_crf, "train", lambda parts, quality: seen.append(sorted(len(f) for f, _ in parts)))
    monkeypatch.setattr(op9_html, "train", lambda texts: seen.append(len(texts)))
    ids = [r.id for r in spark.range(40).where(~op2_line_crf.held_out(F.col("id"))).collect()][:4]
    rows = [(ids[0], f"row {k}\nof one id", "s") for k in range(50)] + [(i, "a\nb\nc", "s") for i in ids[1:]]
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    op2_line_crf.fit(docs(spark, rows), labels)
    op2_line_crf.fit(docs(spark, rows), labels, max_lines=6)
    pages = [(k, f"<p>a long enough text of the page number {i}</p>") for i, k in enumerate([None] * 20 + [1] * 20 + [2])]
    op9_html.fit(spark.createDataFrame(pages, "page_id long, html string"))
    assert seen[0] == [2, 3, 3, 3] and 3 <= sum(seen[1]) <= 6 and seen[2] == 3


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(3)
    good, moves = rng.normal(size=4), rng.normal(size=(2, 2))
    marginal, _, total = op2_line_crf.forward_backward(good, np.array([0, 4]), moves)
    weight = {}
    for n in range(16):
        y = [n >> k & 1 for k in range(4)]
        weight[n] = np.exp(sum(good[k] * y[k] for k in range(4)) + sum(moves[y[k], y[k + 1]] for k in range(3)))
    z = sum(weight.values())
    assert abs(np.log(z) - total[0]) < 1e-9
    for k in range(4):
        assert abs(sum(w for n, w in weight.items() if n >> k & 1) / z - marginal[k]) < 1e-9


def test_main_text(spark):
    words = "the quick brown fox jumps over the lazy dog and runs away from it all . ".split()
    rng = random.Random(6)
    said = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(200)]
    forest = op9_html.train(said, pages=500)
    article = "<article><h1>A  title &amp; more</h1><p>First <b>para</b>graph,\n of text.<p>Second<br>one &lt;here&gt;.</article>"
    page = ("<html><head><title>t</title><script>var x='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li><li><a>More</a></li></ul></nav>"
            f"<div class=\"ad\">Buy now, it is cheap.</div>{article}<div class='comments'><p>I do not agree at all, dear reader.</p></div>"
            "<footer>&copy; all of us</footer></body></html>")
    want = "A title & more\n\nFirst paragraph, of text.\n\nSecond one <here>."
    assert op9_html.extract([page, page[:page.index("</article>")], None, ""], forest) == [want, want, "", ""]
    df = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None)], "page_id long, url string, html string")
    got = op9_html.extract_pages(df, forest).orderBy("page_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [(want, len(want))] * 2 + [("", 0)]


def test_empty_tables(spark):
    none = docs(spark, []).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert op6_jaccard_join.jaccard_join(none).count() == 0
    assert op7_mix.mix(none).count() == 0 and op7_mix.apply_mix(none).count() == 0
    assert op1_license.scan_licenses(none).count() == 0
    assert op2_line_crf.score(none, op2_line_crf.fit(none, labels)).count() == 0
    assert op3_decontaminate.find_leaks(none, bench).count() == 0
    assert op5_token_files.read_token_files(op5_token_files.write_token_files(none, tokenizer_path())).count() == 0
    vectors = spark.createDataFrame([], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]))
    assert op10_neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert op9_html.extract_pages(pages, op9_html.train([], pages=60)).count() == 0
    assert op8_url_filter.filter_urls(pages, op8_url_filter.QUERY_RULES, spark.createDataFrame([("a.b",)], "h string"), keep=["page_id"]).count() == 0


def test_pipeline_run_is_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    import pyarrow as pa
    rng = random.Random(8)
    good = ["The committee described several reasons for the new library.", "A careful reader will find the answer in the second chapter.",
            "Every summer the river carries sand to the old harbour."]
    rows, labels = [], []
    for i in range(60):
        bad = i % 3 == 0
        lines = [" ".join(rng.sample(["buy", "click", "$$$", "!!!", "www", "free", "sale"], 4)) if bad else
                 rng.choice(good) + f" {rng.randrange(10**6)} {rng.randrange(10**6)}" for _ in range(8)]
        rows.append((i, "\n".join(lines), "s"))
        labels.append((i, 0 if bad else 1))
    rows += [(100 + i, rows[i][1] + " end", "s") for i in (1, 2, 4, 5)]            # near copies
    item = "one passage of a benchmark that nobody should train a model on"
    rows += [(200, rows[7][1].replace("\n", f"\n{item}\n", 1) + " own words", "s")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = op2_line_crf.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    fine = [r for r in rows if op2_line_crf.text_scores(pa.array([r[1]]), model)[0] >= op2_line_crf.ACCEPT]
    heads = {c for _, c in brute_components(fine).values()}
    single = [r for r in fine if r[0] in heads]
    left = [r for r in single if item not in r[1]]
    assert len(rows) > len(fine) > len(single) > len(left) > 0
    # One source: all words once, then half of them again by hashed id.
    left.sort(key=lambda r: hashlib.md5(f"{r[0]}:mix-1".encode()).hexdigest())
    more = sum(len(WORD.findall(t)) for _, t, _ in left) // 2
    want = [(i, t) for i, t, _ in left]
    for i, t, _ in left:
        ends = [m.end() for m in WORD.finditer(t)][:more]
        if ends:
            want.append((i, t[:ends[-1]]))
            more -= len(ends)
    encode = Tokenizer.from_file(tokenizer_path()).encode
    ids = [(i, np.array(encode(t, add_special_tokens=False).ids + [0], "<u4")) for i, t in want]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
