"""Pseudonyms against a plain pseudonymiser, and what must hold for each kind of value."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kelpline.llm import pii

KEY = "a key"


def _move(tweak, a, b, v):
    left, right = divmod(v, b)
    prf = lambda n, x, m: int(hashlib.sha256(f"{KEY}|{tweak}|{n}|{x}".encode()).hexdigest()[:15], 16) % m
    for n in range(8):
        if n % 2 == 0:
            left = (left + prf(n, right, a)) % a
        else:
            right = (right + prf(n, left, b)) % b
    return left * b + right


def _luhn(d):
    return sum(sum(divmod(int(c) * (2 if k % 2 else 1), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def _fill(x, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in x)


def _hex(kind, x):
    return hashlib.sha256(f"{KEY}|{kind}|{x}".encode()).hexdigest()


def _card(x):
    d = re.sub("[^0-9]", "", x)
    if not (12 <= len(d) <= 19 and _luhn(d)):
        return x
    body = d[1:-1]
    n = len(body)
    new = d[0] + str(_move(f"card/{d[0]}//{n}", 10 ** (n // 2), 10 ** (n - n // 2), int(body))).zfill(n)
    return _fill(x, new + next(c for c in "0123456789" if _luhn(new + c)))


def _social(x):
    a, g, s = x.split("-")
    if a in ("000", "666") or a[0] == "9" or g == "00" or s == "0000":
        return x
    v = _move("social///9", 898 * 99, 9999, ((int(a) - (2 if int(a) > 666 else 1)) * 99 + int(g) - 1) * 9999 + int(s) - 1)
    a, g, s = v // (99 * 9999) + 1, v // 9999 % 99 + 1, v % 9999 + 1
    return f"{a + (a > 665):03d}-{g:02d}-{s:04d}"


def _date(x, form):
    try:
        day = datetime.datetime.strptime(x, form).date()
    except ValueError:
        return x
    first = datetime.date(day.year // 100 * 100, 1, 1)
    a, b = (75, 487) if first.year % 400 == 0 else (92, 397)
    return (first + datetime.timedelta(days=_move(f"date/{first.year // 100}", a, b, (day - first).days))).strftime(form)


def _ip(x):
    o = [int(p) for p in x.split(".")]
    if max(o) > 255:
        return x
    v = _move("ip", 65536, 65536, int.from_bytes(bytes(o), "big"))
    return ".".join(map(str, v.to_bytes(4, "big")))


def _american(x):
    d = re.sub("[^0-9]", "", x)
    pre, d = d[:-10], d[-10:]
    if not re.match("[2-9]..[2-9]", d):
        r = str(_move(f"ten/{pre}{d[0]}/{d[3]}/8", 10**4, 10**4, int(d[1:3] + d[4:]))).zfill(8)
        return _fill(x, pre + d[0] + r[:2] + d[3] + r[2:])
    v = _move("american", 640_000, 10_000, ((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10_000 + int(d[6:]))
    return _fill(x, f"{pre}{v // 8_000_000 + 200}{v // 10_000 % 800 + 200}{v % 10_000:04d}")


def _samples(rng):
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = {}
    for _ in range(60):
        d = digits(rng.choice([12, 15, 16, 19]) - 1)
        d += next(c for c in "0123456789" if _luhn(d + c))
        for x in (d, digits(16), " ".join(re.findall("....", d)) if len(d) == 16 else d):
            out[x] = _card(x)
        x = f"{digits(3)}-{digits(2)}-{digits(4)}"
        out[x] = _social(x)
        x = ".".join(str(rng.randrange(270)) for _ in range(4))
        out[x] = _ip(x)
        x = f"{rng.randrange(1900, 2101):04d}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 32):02d}"
        for form in ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d.%m.%Y"):
            y, m, d2 = x.split("-")
            z = form.replace("%Y", y).replace("%m", m).replace("%d", d2)
            out[z] = _date(z, form)
        x = rng.choice(["({0}) {1}-{2}", "+1 ({0}) {1}-{2}", "{0}-{1}-{2}", "+1-{0}-{1}-{2}"]).format(digits(3), digits(3), digits(4))
        out[x] = _american(x)
        x = f"User{digits(3)}@Host{digits(2)}.example.org"
        out[x] = "user." + _hex("mail", x.lower())[:20] + "@mail.invalid"
        x = "AKIA" + digits(16)
        out[x] = "AKIA" + _hex("access", x)[:16].upper()
        x = "a" + digits(19) + "f"
        out[x] = _hex("secret", x)[: len(x)]
    return out


def test_against_a_plain_pseudonymiser(spark):
    want = _samples(random.Random(4))
    df = spark.createDataFrame([(x, f"so {x}, and {x} é") for x in want], "x string, text string").repartition(4)
    got = {r.x: r.text for r in pii.pseudonymise(df, key=KEY).collect()}
    wrong = [(x, got[x], y) for x, y in want.items() if got[x] != f"so {y}, and {y} é"]
    assert not wrong, wrong[:5]


def test_numbers_stay_valid_and_apart(spark):
    n = 3000
    rng = random.Random(5)
    social = {f"{rng.choice([*range(1, 666), *range(667, 900)]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10_000):04d}" for _ in range(n)}
    phones = {f"({rng.randrange(200, 1000)}) {rng.randrange(200, 1000)}-{rng.randrange(10_000):04d}" for _ in range(n)} | {f"+49 30 {rng.randrange(10**6):06d}" for _ in range(n)} | {f"+44 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}" for _ in range(n)}
    df = spark.createDataFrame([(x,) for x in sorted(social | phones)], "text string").withColumn("x", F.col("text"))
    got = {r.x: r.text for r in pii.pseudonymise(df, key=KEY).collect()}
    assert len(set(got.values())) == len(got)
    assert all(re.fullmatch(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", got[x]) for x in social)
    assert all(re.fullmatch(r"\([2-9][0-9]{2}\) [2-9][0-9]{2}-[0-9]{4}|\+49 [1-9][0-9] [0-9]{6}|\+44 [1-9][0-9] [0-9]{4} [0-9]{4}", got[x]) for x in phones)


LONG = {
    "mail's labels": "x@" + "a." * 500_000, "labels of two": "x@" + "aa." * 300_000, "at signs": "a@" * 400_000, "local part": "a" * 1_000_000 + "@b.com", "dots": "." * 1_000_000, "digits": "1" * 1_000_000, "hex": "a1" * 500_000,
    "groups": "1234 " * 200_000, "octets": "1." * 500_000, "dates": "2001-01-01 " * 10_000, "slashes": "11/11/" * 100_000, "phones": "(974) 555-3436 " * 5_000, "plus": "+1" * 400_000, "secret": "token=" * 100_000, "secrets": "token=" + "x" * 1_000_000,
    "brackets": "(" * 1_000_000, "hyphens": "123-45-" * 100_000, "wide": "\U0001f600" * 200_000 + "@x.com",
}


@pytest.mark.parametrize("name", LONG)
def test_very_long_texts(spark, name):
    text = LONG[name]
    df = spark.createDataFrame([(text,), (text,), (None,), ("",)], "text string")
    got = [r.text for r in pii.pseudonymise(df, key=KEY, count_col="n").collect()]
    assert got[0] == got[1] and got[2:] == [None, ""]
    if name in ("dates", "phones"):
        assert len(got[0]) == len(text) and text[:14] not in got[0]


def test_private_characters_and_keys(spark):
    rows = ["\ue000 4041894974608795 \ue001a\ue001", "\ue000b none", "\ue001", "mail\ue000 x@host.org"]
    df = spark.createDataFrame([(x, 1) for x in rows], "text string, _parts int")
    got = [r.text for r in pii.pseudonymise(df, key=KEY).collect()]
    assert got[0] == f"\ue000 {_card('4041894974608795')} \ue001a\ue001" and got[1:3] == rows[1:3] and got[3].startswith("mail\ue000 user.")
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymise(df)
    spark.conf.set(pii.KEY_SETTING, KEY)
    try:
        assert [r.text for r in pii.pseudonymise(df).collect()] == got
    finally:
        spark.conf.unset(pii.KEY_SETTING)
