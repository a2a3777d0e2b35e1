import re

import pytest

from kelpline.llm.mixing import mix_sources, mixed_documents
from kelpline.llm.token_counts import count_tokens

TEXTS = ["", " ", "a  b", "a <|endoftext|> b", "x<|endoftext|>y", "a \n b\n\n c", " lead", "trail ", "日本語 é ñ 's 've", "tab\there 12 34 !!", "word " * 3000, None, "dup", "dup"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_the_library_s(docs, name):
    P = pytest.importorskip("public_tokenizers")
    path = P.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        size = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    else:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lambda x: len(sp.encode(x))
    got = {r.doc_id: r for r in count_tokens(docs([(i, x, "en", "s") for i, x in enumerate(TEXTS)]), path).collect()}
    assert len(got) == len(TEXTS)
    for i, x in enumerate(TEXTS):
        assert (got[i].n_tokens, got[i].n_bytes) == (size(x or ""), len((x or "").encode())), x
        assert got[i].over_limit == (got[i].n_tokens > 512)
    assert count_tokens(docs([]), path).count() == 0


def _waterfill(sizes, weights, cap):
    target, open_, left = {}, set(sizes), sum(sizes.values())
    while open_:
        per = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if per * weights[s] > cap * sizes[s]}
        if not over:
            return target | {s: per * weights[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_targets(docs):
    rows = [(i, "w " * (i % 37), None, f"src{i % 5}" if i % 11 else None) for i in range(600)]
    rows += [(1000 + i, "big " * 50, "en", "hot") for i in range(900)] + [(5000, None, "en", "src0"), (5001, "", None, "src1"), (None, "no id", "en", "src1"), (7, "same", "en", "src2"), (7, "same", "en", "src2")]
    df = docs(rows)
    got = mix_sources(df).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mix_sources(df).collect()))
    sizes: dict = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(s for s in sizes if s is not None) + [None]
    target = _waterfill(sizes, {s: k % 3 + 1 for k, s in enumerate(names)}, 3)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * max(50, 37), s
    out = mixed_documents(df)
    assert set(df.columns) < set(out.columns) and out.count() == sum(r.copies for r in got)


def test_mix_of_nothing(docs):
    assert mix_sources(docs([])).count() == 0
    assert mix_sources(docs([(1, None, "en", "a"), (2, "", "en", None)])).agg({"taken": "sum"}).first()[0] == 0


def test_large_groups_are_emitted_by_their_own_crossings(docs):
    """Equal rows and null ids of one size, at rates that rounding a group's mean would turn into none or all."""
    rows = [(7, "five words in each row", "en", "a")] * 500 + [(None, f"four words in {i}", "en", "a") for i in range(500)]
    rows += [(i, "five words in each row", "en", "b") for i in range(700)] + [(None, "five words in each row", "en", "c")] * 500
    df = docs(rows)
    copies: dict = {}
    for r in mix_sources(df).collect():
        assert r.copies >= 0
        copies[r.source, r.doc_id if r.source == "a" else 0] = copies.get((r.source, r.doc_id if r.source == "a" else 0), 0) + r.copies
    assert 0.2 < copies["a", 7] / 500 < 0.45 and 0.2 < copies["a", None] / 500 < 0.45
    out = mixed_documents(df).collect()
    found: dict = {}
    for r in out:
        found[r.source, r.doc_id if r.source == "a" else 0] = found.get((r.source, r.doc_id if r.source == "a" else 0), 0) + 1
    assert found == copies and len(out) == sum(copies.values())
    texts = [r.text for r in out if r.source == "a" and r.doc_id is None]
    assert len(set(texts)) == len(texts)


def test_long_texts_null_ids_and_equal_rows(docs):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    long = "word after word, 12 é " * 60_000
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (None, "x y", "en", None), (None, None, None, None), (2, "a" * 300_000, "en", "b"), (3, " " * 5000, "en", "b")]
    size = {t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in {r[1] or "" for r in rows}}
    got = sorted((str(r.doc_id), r.n_tokens, r.n_bytes) for r in count_tokens(docs(rows), path).collect())
    assert got == sorted((str(i), size[t or ""], len((t or "").encode())) for i, t, *_ in rows)
    words = sorted((str(r.doc_id), r.size) for r in mix_sources(docs(rows)).collect())
    assert words == sorted((str(i), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, *_ in rows)


@pytest.mark.parametrize("cap", [3.0, 1.2, 0.5])
def test_many_sources_share_as_filled_by_water(docs, cap):
    import random

    rng = random.Random(13)
    rows = [(k, "w " * rng.choice([0, 1, 5, 200, 3000]), "en", f"é{rng.randrange(150)}" if k % 3 else f"Z{rng.randrange(90)}") for k in range(700)] + [(9000, "a b c", "en", None)]
    sizes: dict = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = [*sorted(s for s in sizes if s is not None), None]
    target = _waterfill(sizes, {s: k % 3 + 1 for k, s in enumerate(names)}, cap)
    got = {r.source: r.target for r in mix_sources(docs(rows), cap=cap).select("source", "target").distinct().collect()}
    assert got == pytest.approx(target)
