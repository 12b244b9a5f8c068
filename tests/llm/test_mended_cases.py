"""Cases in which results were once lost, forged or late: each against brute force."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import boosted, dom, op1_license, op3_decontaminate, op4_chat, op6_jaccard_join, op7_mix, op8_url_filter, op9_html, op10_neighbours

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def timed(f, *args):
    start = time.time()
    out = f(*args)
    return out, time.time() - start


# --- 9: pages -----------------------------------------------------------------------------------------------------

def text_of(html):
    return dom.block_texts(dom.parse(html)[1])


def outside_tags(html):
    """Text outside tags, read character by character by the rules of the standard."""
    out, i, n = [], 0, len(html)
    while i < n:
        if html.startswith("<!--", i):
            j = i + 4
            if html.startswith(">", j) or html.startswith("->", j):
                i = html.index(">", j) + 1
                continue
            ends = [(k, len(e)) for e in ("-->", "--!>") if (k := html.find(e, j)) >= 0]
            i = min(k + size for k, size in [min(ends)]) if ends else n
        elif html[i] == "<" and i + 1 < n and (html[i + 1] in "!?" or html[i + 1] == "/" and i + 2 < n and not html[i + 2].isalpha()):
            j = html.find(">", i)
            i = n if j < 0 else j + 1
        elif html[i] == "<" and re.match(r"</?[a-zA-Z]", html[i:i + 3]):
            i += 1 + (html[i + 1] == "/")
            while i < n and html[i] not in " \t\n\f\r/>":
                i += 1
            state = "before"
            while i < n:
                c = html[i]
                if state == "double" or state == "single":
                    if c == ('"' if state == "double" else "'"):
                        state = "before"
                elif c == ">":
                    i += 1
                    break
                elif state == "before":
                    state = "before" if c in " \t\n\f\r/" else "name"
                elif state == "name":
                    state = "value" if c == "=" else "before" if c == "/" else "after" if c.isspace() else "name"
                elif state == "after":
                    state = "after" if c.isspace() else "value" if c == "=" else "before" if c == "/" else "name"
                elif state == "value":
                    state = "value" if c.isspace() else "double" if c == '"' else "single" if c == "'" else "unquoted"
                elif state == "unquoted" and c.isspace():
                    state = "before"
                i += 1
            out.append("|")
        else:
            out.append(html[i])
            i += 1
    return "".join(out)


def test_tags_are_read_by_the_rules():
    assert text_of("<p data-x=it's>Hello world.</p><p>It's fine</p><p>end</p>") == "Hello world.\n\nIt's fine\n\nend"
    assert text_of("<p a='x>y' b=\"<p>\" c=d'e\"f>q</p><p =\"g>h</p>") == "q\n\nh"
    assert text_of("<p>a<!--> b <!-- c --> d</p>") == "a b d"
    r, read = random.Random(7), 0
    for _ in range(20_000):
        html = "".join(r.choices(["<p", "<b ", "</p", ">", "'", '"', "=", " ", "/", "x", "y z", "<", "!", "<!--", "-->", "-", "a=", "?"], k=r.randint(1, 14)))
        mine = re.sub(dom.TOKEN, lambda m: "|" if m.group(2) else "", html)
        assert mine == outside_tags(html), html
        read += mine.count("|")
    assert read > 10_000


@pytest.mark.parametrize("piece, times", [("<a ", 1 << 20), ("<a b=\"'", 1 << 19), ("<a", 1 << 20), ("<!", 1 << 20), ("<b>x</b>", 1 << 19), ("&amp", 1 << 20),
                                          ("</x>", 1 << 20), ("<p a=", 1 << 19), ("<svg>", 1 << 20), ("some words and more ", 1 << 19)])
def test_long_markup_takes_linear_time(piece, times):
    """Pages of some MB: a quadratic reading would take hours."""
    small, large = piece * (times // 8), piece * times
    text_of(small)
    _, a = timed(text_of, small)
    _, b = timed(text_of, large)
    assert b < 30 * max(a, 0.02)


def test_open_elements_are_not_searched():
    _, seconds = timed(text_of, "<div>" * 40_000 + "</nav>" * 40_000 + "<li>x" * 40_000 + "<td>y" * 40_000)
    assert seconds < 20


def test_hierarchical_decoding_is_the_best_labelling():
    r = np.random.default_rng(3)
    for _ in range(60):
        root = dom.Node("body", "", None)
        nodes = [root]
        for i in range(7):
            up = nodes[r.integers(0, len(nodes))]
            node = dom.Node("p", "", up)
            up.children.append(node)
            nodes.append(node)
            if r.random() < 0.7:
                node.runs.append([i, "x" * int(r.integers(1, 40))])
        margin = r.normal(size=len(nodes)) * 2
        weight = np.array([0.2 + np.log1p(sum(len(t) for _, t in x.runs)) for x in nodes])

        def value(keep):
            return sum(w * -np.logaddexp(0, -m if k else m) for w, m, k in zip(weight, margin, keep))
        at = {id(x): i for i, x in enumerate(nodes)}
        legal = [k for k in itertools.product([False, True], repeat=len(nodes))
                 if all(not k[i] or k[at[id(x.parent)]] for i, x in enumerate(nodes) if x.parent is not None)]
        op9_html.decode(nodes, margin)
        got = tuple(x.keep for x in nodes)
        assert got in legal and value(got) >= max(map(value, legal)) - 1e-9


def test_boosting_splits_where_the_gain_is_largest():
    r = np.random.default_rng(4)
    x = r.integers(0, 6, size=(300, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (r.random(300) < 0.1)).astype(float)
    forest = boosted.fit(x, y, np.ones(300), trees=1, depth=1, rate=1.0)
    p = y.mean()
    slope, curve = y - p, np.full(300, p * (1 - p))

    def gain(f, b):
        left = x[:, f] <= b
        return sum(slope[s].sum() ** 2 / (curve[s].sum() + 1) for s in (left, ~left))
    best = max(gain(f, b) for f in range(3) for b in np.unique(x[:, f])[:-1])
    assert abs(gain(int(forest.features[0][0]), forest.bounds[0][0]) - best) < 1e-9
    for leaf, side in zip(forest.leaves[0], (x[:, 1] <= forest.bounds[0][0], x[:, 1] > forest.bounds[0][0])):
        assert abs(leaf - slope[side].sum() / (curve[side].sum() + 1)) < 1e-9
    many = boosted.fit(x, y, np.ones(300))
    assert ((many.margin(x) > 0) == (y > 0)).mean() > 0.85


# --- 6: rows that share an id -------------------------------------------------------------------------------------

def components_with_ids(rows):
    """Documents are ids; one links with another if any of their texts do."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        s = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()
        sets.setdefault(i, set()).add(s)
    out, ids = {}, sorted(sets)
    near = {i: {j for j in ids if any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j])} for i in ids}
    for i in ids:
        if i not in out:
            seen, todo = {i}, [i]
            while todo:
                fresh = near[todo.pop()] - seen
                seen |= fresh
                todo += fresh
            out |= dict.fromkeys(seen, i)
    return out


def test_an_id_ties_all_its_texts(spark):
    a, b = "the first text of some words that stand here", "another text that shares nothing with it at all"
    rows = [(5, a), (7, a), (7, b), (9, b), (9, None), (11, None), (3, "x y"), (13, "x y"), (13, ""), (20, ""), (20, "q r s")]
    r = random.Random(2)
    texts = [" ".join(r.choice("abcdefgh") * 3 + str(r.randrange(50)) for _ in range(20)) for _ in range(25)]
    rows += [(100 + r.randrange(30), r.choice(texts)) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op6_jaccard_join.jaccard_join(df).collect()
    want = components_with_ids(rows)
    assert len(got) == len(rows)
    assert {(x.doc_id, x.component_id) for x in got} == set(want.items())
    kept = op6_jaccard_join.keep_one(df).collect()
    assert {x.doc_id for x in kept} == set(want.values())


# --- 10: products beyond a double's range -------------------------------------------------------------------------

def test_overflowing_products_are_neighbours(spark, monkeypatch):
    monkeypatch.setattr(op10_neighbours, "CANDIDATE_BLOCK", 16)
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=4) * 10.0 ** r.choice([-200, 0, 3, 150, 200])).tolist()) for i in range(120)]
    rows += [(200, [1e200, 1e200, 0.0, 0.0]), (220, [1e200, -1e200, 0.0, 0.0]), (240, [1e300] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in op10_neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=12).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    with np.errstate(all="ignore"):
        for q, v in rows:
            if q % 20:
                continue
            scored = [((np.array(v) * np.array(c)).sum(), i) for i, c in rows if i != q]
            scored.sort(key=lambda s: (not np.isnan(s[0]), -s[0] if not np.isnan(s[0]) else 0, s[1]))
            want = [(n, i, s) for n, (s, i) in enumerate(scored[:12], 1)]
            mine = sorted(got[q])
            assert [m[:2] for m in mine] == [w[:2] for w in want]
            assert all(m[2] == w[2] or np.isnan(m[2]) and np.isnan(w[2]) for m, w in zip(mine, want))


# --- 4: parts -----------------------------------------------------------------------------------------------------

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def test_parts_forge_no_turn(spark):
    r = random.Random(3)
    pieces = ["a<", "|end|>b", "<", "\\", "|", "|role|>", "s>", "/s>", "[", "INST]", "/INST]", "", None, "<|text|>", "x"]
    kinds = ["text"] * 6 + ["image", "end", None, "role|>", "audio", "document"]
    rows, said = [], {}
    for c in range(150):
        for t in range(3):
            parts = [(r.choice(kinds), r.choice(pieces), "r", None, None, None, 2) for _ in range(r.randint(0, 6))]
            rows.append((c, t, "user" if t % 2 else "assistant", parts))
            name = {"image": "image", "audio": "audio", "document": "document"}
            said[c, t] = "".join((p[1] or "") if p[0] == "text" else f"<|{name.get(p[0], 'unknown')}|>" for p in parts)
    rows += [(900, 0, "user", None), (901, 0, "assistant", [("text", "a<", None, None, None, None, None), ("text", "|end|>b", None, None, None, None, None)])]
    said |= {(900, 0): "", (901, 0): "a<|end|>b"}
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>")
    made = op4_chat.format_conversations(df)
    turns, losses = op4_chat.read_back(F.col("formatted"), F.col("mask"))
    for x in made.select("conv_id", "attachments", turns.alias("turns"), losses.alias("losses")).collect():
        mine = [row for row in rows if row[0] == x.conv_id]
        assert [t.text for t in x.turns] == [said[row[0], row[1]] for row in mine]
        assert x.losses == [said[row[0], row[1]] for row in mine if row[2] == "assistant"]
        assert [a.type for a in x.attachments] == [p[0] for row in mine for p in row[3] or [] if p[0] != "text"]


# --- 8: hosts -----------------------------------------------------------------------------------------------------

def test_hosts_of_any_number_of_labels(spark):
    r = random.Random(1)
    hosts = [".".join(r.choice(["a", "b", "co", "", "x1"]) for _ in range(r.randint(1, 7))) for _ in range(500)]
    listed = {"a.b", "co", "x1.co.a", "b.b.b.b", ".a", "a."}
    pages = [(i, f"HTTP://{h}/p?q") for i, h in enumerate(hosts)] + [(0, f"http://{hosts[0]}/p")] * 3
    pages += [(9000, "http://" + "l." * 20_000 + "a.b/x"), (9001, "http://" + "l." * 20_000 + "c/x")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    names = spark.createDataFrame([(h,) for h in listed], "host string")
    (got, seconds) = timed(lambda: op8_url_filter.filter_urls(df, (), names, keep=["page_id"]).collect())
    assert len(got) == len(pages) and seconds < 60
    for x in got:
        covered = any(x.host == h or x.host.endswith("." + h) for h in listed)
        assert x.verdict == ("block" if covered else "allow"), x.host
    none = op8_url_filter.filter_urls(df, (), names.limit(0), keep=["page_id"]).collect()
    assert {x.verdict for x in none} == {"allow"}


# --- names, empty tables, long texts, null ids --------------------------------------------------------------------

OWN = "doc_id long, text string, source string, n_chars int, __mix int, __plan string, __extra int, __words int, gone int, c0 int, node long, component_id long"


def test_stages_keep_columns_that_bear_their_own_names(spark):
    rows = [(i, f"some words of the text number {i % 4} and more of it", "s", 5, 1, "p", 2, 3, 4, 6, 7, 8) for i in range(12)]
    df = spark.createDataFrame(rows, OWN)
    mixed = op7_mix.apply_mix(df, length_col="n_chars")
    assert mixed.columns == df.columns and {tuple(x)[4:] for x in mixed.collect()} == {rows[0][4:]}
    kept = op6_jaccard_join.keep_one(df)
    assert kept.columns == df.columns and sorted(tuple(x) for x in kept.collect()) == rows[:4]


def test_empty_conversations_and_pipeline(spark, tmp_path):
    import corpus_pipeline
    empty = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{PART}>")
    assert op4_chat.digest(op4_chat.format_conversations(empty)).count() == 0
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_long_texts_and_null_ids(spark):
    mit = op1_license.TEMPLATES["MIT-permission"]
    item = "one passage of a benchmark that nobody should train a model on"
    long = "lorem ipsum dolor " * 60_000
    rows = [(None, long + mit + " " + item), (None, None), (1, item), (2, long), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(x.doc_id, x.license) for x in op1_license.scan_licenses(df).collect()] == [(None, "MIT-permission")]
    bench = spark.createDataFrame([(None, item), (4, item), (5, None)], "item_id long, text string")
    got = sorted(((x.doc_id, x.item_id) for x in op3_decontaminate.find_leaks(df, bench).collect()), key=str)
    assert got == sorted([(None, None), (None, 4), (1, None), (1, 4)], key=str)
    assert sorted((x.doc_id or 0, len(x.text or "")) for x in op3_decontaminate.drop_leaks(df, bench).collect()) == [(0, 0), (0, 1), (2, len(long))]


# --- 3: walks and bit sampling ------------------------------------------------------------------------------------

def edited(rng, item, edit):
    at = rng.choice(len(item), len(item) // 5, replace=False)
    fresh = rng.integers(1, 2**63, len(at)).astype(np.uint64)
    run = item.copy()
    run[at] = fresh
    return {"change": run, "insert": np.insert(item, at, fresh), "delete": np.delete(item, at)}[edit]


@pytest.mark.parametrize("size, n_items", [(3, 60), (5, 60), (7, 60), (10, 60), (14, 60), (30, 40), (200, 20), (1000, 6), (3000, 3)])
def test_walks_recall_leaks_of_the_most_edits(size, n_items):
    rng = np.random.default_rng(size)
    items = list(rng.integers(1, 2**63, (n_items, size)).astype(np.uint64))
    index = op3_decontaminate.Index(list(range(n_items)), items)
    for edit in ("change", "insert", "delete"):
        texts = [np.concatenate([rng.integers(1, 2**63, 20).astype(np.uint64), edited(rng, item, edit), rng.integers(1, 2**63, 9).astype(np.uint64)])
                 for item in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        pairs = {tuple(p) for p in index.candidates(np.concatenate(texts), offsets).tolist()}
        kept = sum((i, i) in pairs for i in range(n_items))
        assert kept >= 0.95 * n_items, (size, edit, kept)
        assert len(pairs) <= 1.05 * n_items                                    # no other item
        found = index.leaks(np.concatenate(texts), offsets)
        assert set(found) == {p for p in pairs if p[0] == p[1]}


def test_walks_reject_unrelated_windows():
    """Texts made of the items' own runs of three words, in other orders: every place
    passes the screen, and few items are candidates."""
    rng = np.random.default_rng(3)
    items = list(rng.integers(1, 2**63, (50, 60)).astype(np.uint64))
    index = op3_decontaminate.Index(list(range(50)), items)
    every = np.concatenate(items).reshape(-1, 3)
    texts = [rng.permutation(every)[:100].ravel() for _ in range(40)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = np.concatenate(texts)
    screened = sum(len(s.places(words, offsets)) for s in index.segments)
    assert screened > 0.3 * len(words)
    windows = 40 * 50                                         # pairs of a text and an item
    assert len(index.candidates(words, offsets)) < 0.6 * windows
    assert not index.leaks(words, offsets)
    plain = rng.integers(1, 2**63, 20_000).astype(np.uint64)
    assert not len(index.candidates(plain, np.array([0, 20_000])))


def test_walks_never_count_what_is_behind_an_end():
    rng = np.random.default_rng(4)
    item = rng.integers(1, 2**63, 12).astype(np.uint64)
    index = op3_decontaminate.Index([0], [item])
    # The text ends within the segment: what is behind belongs to another text.
    words = np.concatenate([item[:6], item[6:]])
    assert len(index.leaks(words, np.array([0, 12]))) == 1
    assert not index.leaks(words, np.array([0, 6, 12]))


# --- 6: counting in place of heap merging and probing -----------------------------------------------------------

def heap_merged(lists, least):
    """(document, lists that hold it) for those in ``least`` lists: the smallest heads
    are popped, and lists that can't matter skip to the next head left."""
    from bisect import bisect_left
    from heapq import heapify, heappop, heappush
    heap = [(own[0], i, 0) for i, own in enumerate(lists) if own]
    heapify(heap)
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap))
        if len(popped) >= least:
            yield top, len(popped)
            goal = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heappop(heap))
            if not heap:
                return
            goal = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], goal, at)
            if at < len(lists[i]):
                heappush(heap, (lists[i][at], i, at))


def test_counting_links_what_heap_merging_and_probing_link():
    from bisect import bisect_left
    rng = np.random.default_rng(6)
    for rows, edits, shared in ((60, 8, 0), (60, 30, 0), (40, 10, 20), (80, 45, 30)):
        base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
        sets = []
        for _ in range(rows):
            own = base.copy()
            at = shared + rng.choice(60 - shared, rng.integers(0, min(edits, 60 - shared) + 1), replace=False)
            own[at] = rng.integers(0, 1 << 60, len(at))
            sets.append(np.unique(own))
        lists = {}
        for i, own in enumerate(sets):
            for t in own.tolist():
                lists.setdefault(t, []).append(i)
        long = {t for t, own in lists.items() if len(own) > rows // 3}
        want = set()
        for r, own in enumerate(sets):
            short, probed = [lists[t] for t in own.tolist() if t not in long], [lists[t] for t in own.tolist() if t in long]
            least = -(-80 * len(own) // 100) - len(probed)
            found = heap_merged(short, least) if least > 0 else ((j, sum(j in x for x in short)) for j in range(rows))
            for j, n in found:
                n += sum((at := bisect_left(x, j)) < len(x) and x[at] == j for x in probed)
                if j != r and 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                    want.add((min(j, r), max(j, r)))
        got = op6_jaccard_join.divide_skip(sets)
        assert {(min(p), max(p)) for p in got} <= want

        def classes(links):
            out = list(range(rows))
            for a, b in sorted(links):
                low, high = sorted((out[a], out[b]))
                out = [low if x == high else x for x in out]
            return out
        assert classes(got) == classes(want)


# --- 7: the cut within an id that repeats -----------------------------------------------------------------------

def test_mix_cuts_within_one_repeated_id(spark):
    r = random.Random(4)
    rows = [(7, " ".join(["w"] * r.randint(1, 6)) + f" {i}", "s") for i in range(200)] + [(i, "a b c", "s") for i in range(5)]
    rows += [(9, "x y", None)] * 40 + [(8, f"t {i}", "r") for i in range(30)]
    got = op7_mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    total = sum(len(WORD.findall(t)) for _, t, _ in rows)
    by = {}
    for x in got:
        assert 0 <= x.taken <= 2 * x.size
        by.setdefault((x.source_size, x.target), []).append(x.taken)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) < 40                   # equal rows share the words left evenly
    exact = [k for k in by if k[0] == sum(len(WORD.findall(t)) for _, t, s in rows if s == "s")]
    assert abs(sum(by[exact[0]]) - exact[0][1]) <= 5
