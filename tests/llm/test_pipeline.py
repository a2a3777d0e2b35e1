import random

import corpus_pipeline as pipeline

WORDS = {"en": "the of and that with from which thing over under", "fr": "le la être où français déjà avec pour dans elle", "de": "der die das über können straße nicht auch wird haben", "es": "el los niño mañana qué por para señor está como"}


def _rows():
    rng = random.Random(8)
    rows = []
    for i in range(240):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) + str(rng.choice(["", "s", "er", "um", "or"])) for _ in range(120)), lang, f"s{i % 4}"))
    passage = " ".join(f"bench{k}" for k in range(14))
    near = rows[0][1].split()
    near[60] = "changed"
    rows += [(300, rows[0][1], rows[0][2], "s0"), (301, " ".join(near), rows[0][2], "s1"), (302, rows[5][1] + " " + passage, rows[5][2], "s2"), (303, rows[7][1][::-1] + " call +1 (974) 555-3436 now", "en", "s3"), (304, "123 456 !!!", "en", "s0"), (305, None, "en", "s0"), (306, "", "en", "s0")]
    return rows, passage


def test_each_stage_does_its_own(spark, docs, tmp_path):
    rows, passage = _rows()
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixing"]
    sf = str(tmp_path)
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    df, seen = docs(rows), {}
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES:
        out = stage(spark, df, sf)
        if name != "mixing":
            assert tuple(out.columns) == pipeline.COLUMNS
        out.write.parquet(f"{sf}/out-{name}")
        df = spark.read.parquet(f"{sf}/out-{name}")
        seen[name] = {r.doc_id: r for r in df.collect()}
    assert {i for i, *_ in rows} - set(seen["language"]) == {304, 305, 306}
    gone = set(seen["language"]) - set(seen["near_duplicates"])
    assert {300, 301} <= gone <= {300, 301, 5, 302} and 0 in seen["near_duplicates"]
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) <= {302} and 302 not in seen["decontamination"]
    assert set(seen["personal_data"]) == set(seen["decontamination"]) and "555-3436" not in seen["personal_data"][303].text
    assert seen["personal_data"][303].n_chars == len(seen["personal_data"][303].text)
    assert pipeline.run(spark, sf).count() == df.count() > 0


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_texts_of_no_learned_language_go(spark):
    rng = random.Random(21)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "s", "en"]) for _ in range(n))
    clean = [(i, text(lang := rng.choice(["en", "fr", "de"]), rng.choice([2, 10, 100])), lang, "s") for i in range(900)]
    foreign = [(1000 + i, " ".join(rng.choice(["привет", "как", "дела", "хорошо", "спасибо", "где", "это"]) for _ in range(60)), None, "s") for i in range(20)]
    junk = [(2000 + i, "".join(rng.choice("qxzjvkwy") for _ in range(300)), None, "s") for i in range(20)]
    got = {r.doc_id for r in pipeline.identify_language(spark, _frame(spark, clean + foreign + junk), "").collect()}
    assert got == {r[0] for r in clean}


def test_stages_on_nothing_and_on_odd_rows(spark, tmp_path):
    """Empty tables; null ids, texts, languages and sources; equal rows: each stage has its result, with the columns of documents."""
    sf = str(tmp_path)
    spark.createDataFrame([(0, "ten words that no document below has in a row"), (None, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    odd = [(None, None, None, None), (None, None, None, None), (1, "", "en", None), (2, "some words", None, "a"), (2, "some words", None, "a"), (None, "some words", "en", "a"), (3, "1 2 3", "en", "b")]
    for rows in ([], odd):
        df = _frame(spark, rows)
        for name, stage in pipeline.STAGES:
            out = stage(spark, df, sf)
            assert tuple(out.columns)[:5] == pipeline.COLUMNS and out.count() <= 3 * len(rows), name
            if name in ("decontamination", "personal_data"):
                assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_one_row_of_each_component_stays(spark):
    """Repeated and null ids: equal rows, near copies under an id that stays elsewhere, copies without an id."""
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    near = a.replace(a.split()[30], "changed", 1)
    rows = [(1, a, "s0")] * 40 + [(1, a, "s1"), (2, near, "s0"), (2, b, "s0"), (2, b, "s0"), (7, b, "s0")]
    rows += [(None, c, "s0")] * 60 + [(None, near, "s0"), (9, d, "s0"), (None, d, "s0"), (None, e, "s1"), (None, None, "s0"), (5, "!!!", "s0"), (5, "!!!", "s0"), (6, "!!!", "s0")]
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = sorted((tuple(r) for r in pipeline.drop_near_duplicates(spark, df, "").collect()), key=str)
    want = [(1, a, "s0"), (2, b, "s0"), (None, c, "s0"), (9, d, "s0"), (None, e, "s1"), (None, None, "s0"), (5, "!!!", "s0"), (6, "!!!", "s0")]
    assert got == sorted(((i, t, "en", s, len(t or "")) for i, t, s in want), key=str)
