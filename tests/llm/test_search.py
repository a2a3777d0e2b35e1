import collections
import hashlib
import random

import numpy as np
import pytest

from kelpline.llm.decontaminate import contamination_report, find_contamination
from kelpline.llm.jaccard_join import jaccard_links
from kelpline.llm.lattice import near_vectors
from kelpline.llm.licenses import TEMPLATES, scan_licenses
from kelpline.llm.suffix_dedup import remove_repeats


def _prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _brute_contamination(rows, items, words, window=10):
    out = {}
    for i, t, *_ in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            grams = {tuple(b[k : k + window]) for k in range(len(b) - window + 1)} if len(b) >= window else ({tuple(b)} if b else set())
            for g in grams:
                for k in range(len(w) - len(g) + 1):
                    if tuple(w[k : k + len(g)]) == g:
                        hit |= set(range(k, k + len(g)))
                        found.add("" if item is None else str(item))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def _brute_matches(t, items, words, window):
    """Maximal common stretches by diagonals: (first, past, item, item_first), of windows (shorter items as a whole)."""
    w, found = words(t), set()
    for item, text in items:
        b = words(text)
        n = min(window, len(b))
        hits = {(k, o) for o in range(len(b) - n + 1) for k in range(len(w) - n + 1) if n and w[k : k + n] == b[o : o + n]}
        for k, o in hits:
            if (k - 1, o - 1) not in hits:
                past = k
                while (past + 1, o + past + 1 - k) in hits:
                    past += 1
                found.add((k, past + n, "" if item is None else str(item), o))
    return found


@pytest.mark.parametrize(("index_bytes", "item_words"), [(1 << 27, 1 << 16), (3000, 1 << 16), (6000, 14), (1 << 27, 14)])
def test_contamination_against_brute_force(spark, docs, words, monkeypatch, index_bytes, item_words):
    from kelpline.llm import decontaminate

    monkeypatch.setattr(decontaminate, "ITEM_WORDS", item_words)
    rng = random.Random(3)
    items = [(k, _prose(rng, 30, 60)) for k in range(6)] + [(10, "Short Item here"), (11, "one"), (2, _prose(rng, 12)), (12, None), (13, ""), (None, _prose(rng, 11, 60))]
    items.append((20, items[0][1][30:] + " " + items[1][1]))
    rows = [(0, None, "en", "s"), (1, "", "en", "s"), (2, "SHORT item, here!", "en", "s"), (3, "one", "en", "s"), (4, items[0][1].upper(), "en", "s"), (5, "é one é", "en", "s"), (6, items[0][1] + " " + items[1][1], "en", "s"), (6, items[0][1] + " " + items[1][1], "en", "s"), (None, items[2][1], None, None)]
    for k in range(40):
        a = items[rng.randrange(6)][1].split()
        rows.append((10 + k, _prose(rng, rng.randrange(40)) + " " + " ".join(a[rng.randrange(15) :][: rng.randrange(25)]) + " - " + _prose(rng, 5, 60), "en", "s"))
    rows.append((100, _prose(rng, 6_000) + " " + items[3][1], "en", "s"))
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    found = find_contamination(docs(rows), bench, index_bytes=index_bytes).cache()
    got = contamination_report(found).collect()
    assert len(got) == len(rows) and {r.doc_id: tuple(r)[1:] for r in got} == _brute_contamination(rows, items, words)
    matches = {r.doc_id: {(m.first, m.past, m.item_id, m.item_first) for m in r.matches} for r in found.collect()}
    texts = {r[0]: r[1] for r in rows}
    for i in (4, 6, None, 100, *range(10, 50)):
        assert matches[i] == _brute_matches(texts[i], items, words, 10), i
    assert contamination_report(find_contamination(docs([]), bench)).count() == 0
    assert not contamination_report(find_contamination(docs(rows), bench.limit(0))).where("contaminated").count()


def test_words_are_compared_by_their_bytes(spark, docs, monkeypatch):
    """With a hash that tells only lengths, the spelling decides."""
    from kelpline.llm import decontaminate

    real = decontaminate.words
    monkeypatch.setattr(decontaminate, "words", lambda data, at: (lambda h, o, a, b: ((b - a).astype(np.uint64), o, a, b))(*real(data, at)))
    index = decontaminate.build_index([("x", 0, "a bb ccc dddd")], 10)
    import pyarrow as pa

    part = pa.RecordBatch.from_arrays([pa.array(["A bb CCC dddd", "a bb cxc dddd", "e ff ggg hhhh a bb ccc dddd"])], names=["text"])
    _, (text, _, first, past, _) = decontaminate._scan(part, index, 10)
    assert list(zip(text.tolist(), first.tolist(), past.tolist(), strict=True)) == [(0, 0, 4), (2, 4, 8)]
    with pytest.raises(ValueError, match="hash"):
        decontaminate.build_index([("x", 0, "aa bb")], 10)


def _brute_links(rows, words, percent=80):
    sets = []
    for _, t, *_ in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least: dict = {}
    for k in range(len(rows)):
        i = rows[k][0]
        least[root(k)] = i if least.get(root(k)) is None else min(least[root(k)], i) if i is not None else least[root(k)]
    return collections.Counter((rows[k][0], links[k], least[root(k)] if sets[k] else rows[k][0]) for k in range(len(rows)))


def test_jaccard_links_against_brute_force(docs, words):
    rng = random.Random(5)
    rows = [(0, None, "en", "s"), (1, "", "en", "s"), (2, "Two words", "en", "s"), (3, "two WORDS!", "en", "s"), (4, "...", "en", "s"), (None, "no id at all here", "en", "s"), (7, "same id", "en", "s"), (7, "other text with the same id here", "en", "s"), (7, "same id", "en", "s")]
    for fam in range(12):
        base = _prose(rng, rng.choice([8, 30, 120, 700])).split()
        for _ in range(rng.choice([1, 2, 5, 60])):
            x = list(base)
            for _ in range(rng.randrange(0, max(2, len(x) // 50))):
                x[rng.randrange(len(x))] = f"e{rng.randrange(9999)}"
            rows.append((len(rows) + 100, " ".join(x), "en", f"s{fam}"))
    passage = _prose(rng, 60)
    rows += [(2000 + k, _prose(rng, 40) + " " + passage, "en", "s") for k in range(30)]
    rng.shuffle(rows)
    got = collections.Counter((r.doc_id, r.n_links, r.component_id) for r in jaccard_links(docs(rows), bucket=16).collect())
    assert got == _brute_links(rows, words)
    assert jaccard_links(docs([])).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_isolated_pairs_are_found_at_any_similarity(docs, words, percent):
    """Pairs just above and just below the threshold, of long and short texts, each linked with nothing else."""
    rng = random.Random(percent)
    rows = []
    for k in range(150):
        n = rng.choice([25, 60, 200])
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        # a changed tail of c words leaves n - 4 - c of n - 4 shingles: Jaccard (n - 4 - c) / (n - 4 + c)
        c = round((n - 4) * (100 - percent) / (100 + percent)) + rng.choice([-1, -1, 0, 1])
        rows += [(2 * k, " ".join(base), "en", "s"), (2 * k + 1, " ".join(base[: n - c] + [f"x{rng.randrange(10**6)}" for _ in range(c)]) if c > 0 else " ".join(base), "en", "s")]
    got = collections.Counter((r.doc_id, r.n_links, r.component_id) for r in jaccard_links(docs(rows), similarity=percent / 100).collect())
    want = _brute_links(rows, words, percent)
    linked = sum(links for (_, links, _), _ in want.items())
    assert linked > 60 and not [x for x in got if x[1] > max(y[1] for y in want if y[0] == x[0])]
    assert sum(links for (_, links, _), _ in got.items()) >= 0.99 * linked


def test_runs_follow_the_recall():
    from kelpline.llm.jaccard_join import runs_for

    assert runs_for(0.8, 0.999, 3) > runs_for(0.8, 0.9, 3) and runs_for(0.5, 0.999, 3) > runs_for(0.8, 0.999, 3) > runs_for(0.8, 0.999, 1)


def test_large_groups_and_long_texts_are_compared_in_blocks(docs, words, monkeypatch):
    """More near copies than a block holds, a text of more shingles than a block holds, and equal rows."""
    from kelpline.llm import groups

    monkeypatch.setattr(groups, "BLOCK", 40)
    monkeypatch.setattr(groups, "BLOCK_VALUES", 4000)
    rng = random.Random(11)
    base = _prose(rng, 80, 5000).split()
    rows = []
    for k in range(230):
        x = list(base)
        for _ in range(rng.randrange(3)):
            x[rng.randrange(len(x))] = f"e{rng.randrange(9999)}"
        rows.append((k, " ".join(x), "en", "s"))
    long = _prose(rng, 30_000, 10**6)
    rows += [(1000, long, "en", "s"), (1001, long + " and more", "en", "s"), (1002, long[100:], "en", "s"), (1002, long[100:], "en", "s"), (None, rows[0][1], "en", "s")] + [(7000, rows[3][1], "en", "s")] * 50
    got = collections.Counter((r.doc_id, r.n_links, r.component_id) for r in jaccard_links(docs(rows), bucket=8).collect())
    assert got == _brute_links(rows, words)


def _brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        out.append((len(t), int(gone.sum()), len(edges), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1024, 8, 2, 0])
def test_repeats_against_brute_force(docs, hot, monkeypatch):
    """Also where samples are hot at every level, and equal pieces meet in several rounds of a task."""
    from kelpline.llm import suffix_dedup

    if hot == 2:
        monkeypatch.setattr(suffix_dedup._Merged, "LIMIT", 3000)
    rng = random.Random(9)
    base = ["".join(rng.choice("abcd é") for _ in range(800)) for _ in range(3)]
    texts = [None, "", "a" * 900, "ab" * 120, "é" * 150, base[0], base[0]]
    for k in range(70):
        a = rng.randrange(400)
        x = list(base[k % 3][a : a + rng.randrange(120, 400)])
        for _ in range(rng.randrange(3)):
            x[rng.randrange(len(x))] = f"<{k}>"
        texts.append(_prose(rng, rng.randrange(30)) + "".join(x) + ("De " * rng.randrange(200) if k % 9 == 0 else ""))
    for n in (100, 140, 190, 198, 199, 200, 260):  # strings of n bytes in different surroundings
        common = "".join(rng.choice("xyz") for _ in range(n))
        texts += ["".join(rng.choice("mnop") for _ in range(150)) + common + "".join(rng.choice("mnop") for _ in range(150)) for _ in range(12)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs(rows), hot=hot).collect()}
    want = dict(enumerate(_brute_repeats(texts, 200)))
    assert got == want
    if hot == 8:
        kept = {r.doc_id: bytes(r.kept) for r in remove_repeats(docs(rows), with_text=True).select("doc_id", "kept").collect()}
        assert {k: hashlib.sha256(v).hexdigest() for k, v in kept.items()} == {k: v[3] for k, v in want.items()}
        assert remove_repeats(docs([])).count() == 0
        unnamed = remove_repeats(docs([(None, base[1], "en", "s"), (None, base[1], "en", "s"), (None, "x", "en", "s")])).collect()
        assert sorted(r.n_removed for r in unnamed) == [0, len(base[1].encode()), len(base[1].encode())]


@pytest.mark.parametrize("hot", [1024, 4])
def test_repeats_across_the_tiles_of_long_texts(docs, hot):
    rng = random.Random(12)
    fresh = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, tile = fresh(3000), 1 << 18
    long = fresh(tile - 1500) + passage + fresh(tile - 1600) + passage[:250] + fresh(2000)
    texts = [long, fresh(700) + passage[100:900] + fresh(50), fresh(tile - 199), "q" * (tile + 5000), fresh(tile + 10)[:-1] + passage[2800:]]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs([(k, t, "en", "s") for k, t in enumerate(texts)]), hot=hot).collect()}
    assert got == dict(enumerate(_brute_repeats(texts, 200)))


def _brute_vectors(rows):
    good = [r for r in rows if r[1] and None not in r[1] and r[2] is not None and np.isfinite(r[1]).all() and any(r[1])]
    links, parent = [0] * len(good), list(range(len(good)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.array(r[1], np.float32).astype(float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) for r in good]
    for a in range(len(good)):
        for b in range(a):
            if good[a][2] == good[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least: dict = {}
    for k, r in enumerate(good):
        least[root(k)] = min(r[0], least.get(root(k), r[0]))
    want = collections.Counter((r[0], links[k], least[root(k)]) for k, r in enumerate(good))
    want.update((r[0], 0, r[0]) for r in rows if not any(r is g for g in good))
    return want


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, copies long, name string, path string")


def _linked(df):
    return collections.Counter((r.vec_id, r.n_links, r.component_id) for r in df.collect())


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(150):
        x = rng.standard_normal(64)
        for j in range(rng.integers(1, 5)):
            y = x + rng.standard_normal(64) * rng.choice([0.0, 0.05, 0.15, 0.2])
            rows.append((len(rows), [float(np.float32(v)) for v in y * rng.choice([1.0, 3.0, 1e-30, 1e30])], int(k % 3)))
    rows += [(9000, None, 1), (9001, [0.0] * 64, 1), (9002, [float("nan")] + [1.0] * 63, 1), (9003, [float("inf")] + [1.0] * 63, 1), (9004, [None] + [1.0] * 63, 1), (9005, rows[0][1], None), (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), (9008, [], 1), (9009, rows[1][1], rows[1][2]), (9009, rows[1][1], rows[1][2])]
    df = _vectors(spark, rows)
    assert _linked(near_vectors(df)) == _brute_vectors(rows)
    assert near_vectors(df.limit(0)).count() == 0
    unnamed = near_vectors(_vectors(spark, [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [2.0, 4.1], 1)])).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in unnamed) == [("4", 2, 4), ("None", 2, 4), ("None", 2, 4)]


@pytest.mark.parametrize(("dim", "one_large"), [(4, False), (16, False), (64, False), (768, False), (2048, True)])
def test_isolated_vectors_are_found_in_any_dimension(spark, dim, one_large):
    """Pairs at cosine 0.9801 each, also where one component dwarfs all others."""
    rng = np.random.default_rng(dim)
    rows = []
    for k in range(120):
        x, e = rng.standard_normal((2, dim))
        if one_large:
            x[0] = 40 * np.sqrt(dim)
        x /= np.linalg.norm(x)
        e -= (e @ x) * x
        e /= np.linalg.norm(e)
        rows += [(2 * k, x.astype(np.float32).tolist(), k if one_large or dim < 16 else 0), (2 * k + 1, (0.9801 * x + np.sqrt(1 - 0.9801**2) * e).astype(np.float32).tolist(), k if one_large or dim < 16 else 0)]
    assert _linked(near_vectors(_vectors(spark, rows))) == _brute_vectors(rows)


def test_crowded_cells_are_split_and_compared_in_blocks(spark, monkeypatch):
    from kelpline.llm import lattice

    monkeypatch.setattr(lattice, "BLOCK", 40)
    rng = np.random.default_rng(6)
    rows = []
    for noise, n in ((0.012, 150), (0.02, 100), (0.3, 150)):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        rows += [(len(rows) + k, (x + rng.standard_normal(64) * noise).astype(np.float32).tolist(), 1) for k in range(n)]
    df = _vectors(spark, rows)
    want = _brute_vectors(rows)
    assert _linked(near_vectors(df)) == want
    got = _linked(near_vectors(df, crowd=16))
    assert sum(x[1] for x in got) >= 0.995 * sum(x[1] for x in want)


def test_licenses_are_found_wherever_they_stand(docs, words):
    rng = random.Random(6)
    rows, want = [(0, None, "en", "s"), (1, "", "en", "s"), (2, "license", "en", "s")], {}
    for name, text in TEMPLATES.items():
        for at in (0, 3, 17, 200):
            i = len(rows) + 10
            rows.append((i, _prose(rng, at) + " " + text.upper() + " " + _prose(rng, 30), "en", "s"))
            want[i] = name
    long = TEMPLATES["MIT"].split()
    long[10] = "CHANGED"
    rows.append((900, _prose(rng, 9) + " " + " ".join(long), "en", "s"))
    rows.append((901, " ".join(long[:40]), "en", "s"))
    got = {r.doc_id: r for r in scan_licenses(docs(rows)).collect()}
    shingles = lambda t: {tuple(words(t)[k : k + 5]) for k in range(len(words(t)) - 4)}
    text_of = {r[0]: r[1] for r in rows}
    for i, name in want.items():
        assert name in got[i].licenses
        for other, c in zip(got[i].licenses, got[i].containment):
            assert c >= 0.8 and len(shingles(TEMPLATES[other]) & shingles(text_of[i])) >= 0.8 * len(shingles(TEMPLATES[other]))
    assert got[900].licenses == ["MIT"] and got[901].licenses == [] and got[0].licenses == []
    assert scan_licenses(docs([])).count() == 0


def test_every_containment_is_found(docs, words):
    """Against all stretches of a template's length: what holds 0.8 of its shingles is reported, or a variant that fits better is."""
    from kelpline.llm.licenses import prepare

    rng = random.Random(16)
    known = prepare(TEMPLATES)
    long = " ".join(["again and again the same six words"] * 12)  # many shingles, few of them distinct
    templates = {**TEMPLATES, "repeats": long + " " + _prose(rng, 12)}
    rows = []
    for k in range(120):
        name = rng.choice([n for n in templates if len(templates[n].split()) > 15])
        x = templates[name].split()
        for _ in range(rng.choice([0, 0, 1, 2, len(x) // 25, len(x) // 12])):
            x[rng.randrange(len(x))] = "changed"
        rows.append((k, _prose(rng, rng.randrange(300)) + " " + " ".join(x) + " " + _prose(rng, rng.randrange(300)), "en", "s"))
    rows += [(500, None, "en", "s"), (None, TEMPLATES["ISC"], None, None), (7, rows[7][1], "en", "s"), (501, _prose(rng, 200_000) + TEMPLATES["ISC"] + _prose(rng, 100_000), "en", "s")]
    got = [(r.doc_id, tuple(r.licenses)) for r in scan_licenses(docs(rows), templates=templates).collect()]
    shingles = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    sets = {n: shingles(words(t)) for n, t in templates.items()}
    found = dict(got)
    for i, t, *_ in rows[:120]:
        own = shingles(words(t))
        for n, s in sets.items():
            if len(s) < 2:
                continue
            whole = set(s)
            most = max((len(whole & set(own[a : a + len(s)])) for a in range(max(1, len(own) - len(s) + 1))), default=0) / len(whole)
            variants = known.variants[known.names.index(n)] if n in known.names else []
            if most >= 0.8:
                assert n in found[i] or any(v in found[i] for v in variants), (i, n)
    assert found[None] == ("ISC",) == found[501] and found[500] == () and len(got) == len(rows)
