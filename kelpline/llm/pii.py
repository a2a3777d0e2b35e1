"""Format-preserving pseudonyms of personal data, with Spark's own functions only.

Numbers (payment cards, phone numbers, IPv4 addresses, social security numbers) and dates that are
valid are permuted within the valid ones of their format by a keyed Feistel network, so equal values
stay equal in all documents, different ones stay different, and the new value is valid too. Mail
addresses and secrets have no such format; they become keyed tokens of the same kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the setting that holds the key, if the caller passes none.
KEY_SETTING = "kelpline.pseudonym.key"

# No repeat over a group is unbounded: Java's regular expressions recurse on each round of one, and a long text would end the JVM.
_LOCAL = r"[^\x00-\x20\x7F\"'(),:;<>@\[\]\\|=]"
_NO_DIGIT_BEFORE, _NO_DIGIT_AFTER = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"

#: What is looked for, most telling first; each is checked again as a whole by its kind.
MAIL = rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+@[A-Za-z0-9-]{{1,63}}+(?:\.[A-Za-z0-9-]{{1,63}}+){{1,126}}(?<=\.[A-Za-z]{{2,24}})"
ACCESS_KEY = rf"AKIA[0-9A-Z]{{16}}{_NO_DIGIT_AFTER}"
HEX_SECRET = rf"(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{{16,128}}{_NO_DIGIT_AFTER}"
SECRET = r"(?<==)(?<=[Pp]assword=|PASSWORD=|[Ss]ecret=|SECRET=|[Tt]oken=|TOKEN=)[^\s\"']{6,128}+"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-]|\.[0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![0-9A-Za-z])|(?<![0-9A-Za-z])[0-9]{12,19}(?![0-9A-Za-z])"
#: Of all but mail addresses and secrets the first character is one of a few, which is tested before anything else.
ANY = f"{MAIL}|(?=[0-9+(])(?:{IP}|{DATE}|{SOCIAL}|{CARD}|{PHONE})|(?=[0-9A-Fa-f]){_NO_DIGIT_BEFORE}(?:{ACCESS_KEY}|{HEX_SECRET})|{SECRET}"
#: No text without one of these holds any of the above.
HINT = "[0-9@]|[Pp]assword=|PASSWORD=|[Ss]ecret=|SECRET=|[Tt]oken=|TOKEN="

ROUNDS = 8
#: Finds are set off by one private character; where a text has it, or the one that it is written with, they are written with the latter.
_MARK, _ESCAPE = "\ue000", "\ue001"
# Countries whose calling code has two digits; those of one are 1 and 7, all others have three.
_TWO_DIGIT_COUNTRIES = "^(?:20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def key_of(spark: SparkSession, key: str | None) -> str:
    """The caller's key, or that of the session's setting; there is no key in this package."""
    key = key or spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"pseudonyms need a key: pass one or set {KEY_SETTING}")
    return key


def _prf(tweak: Column, n: int, x: Column, size: Column) -> Column:
    """A keyed pseudo-random number below ``size``: 60 bits of SHA-256 (the key is part of the tweak)."""
    digest = F.sha2(F.concat(tweak, F.lit(f"|{n}|"), x.cast("string")).cast("binary"), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)


def _rounds(states: Column) -> Column:
    """The Feistel network over an array of structs (m with a, b and tweak; l, r): the halves are shifted in turn modulo a and b.

    Unrolled, one pass over the array a round, so that no expression is evaluated more than once. Where a is null nothing moves.
    """

    def turn(n: int) -> Callable[[Column], Column]:
        def step(y: Column) -> Column:
            m = y["m"]
            if n % 2 == 0:
                return F.struct(m.alias("m"), F.when(m["a"].isNotNull(), F.pmod(y["l"] + _prf(m["tweak"], n, y["r"], m["a"]), m["a"])).alias("l"), y["r"].alias("r"))
            return F.struct(m.alias("m"), y["l"].alias("l"), F.when(m["a"].isNotNull(), F.pmod(y["r"] + _prf(m["tweak"], n, y["l"], m["b"]), m["b"])).alias("r"))

        return step

    for n in range(ROUNDS):
        states = F.transform(states, turn(n))
    return states


def feistel(key: str, tweak: str, a: int, b: int, value: Column) -> Column:
    """A keyed permutation of 0 .. a*b-1: value = left * b + right."""
    m = F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"), F.lit(f"{key}|{tweak}").alias("tweak"))
    start = F.array(F.struct(m.alias("m"), F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r")))
    return F.element_at(F.transform(_rounds(start), lambda y: y["l"] * b + y["r"]), 1)


def luhn_sum(digits: Column) -> Column:
    """Sum of Luhn's algorithm over a string of digits, the last one taken once."""
    n = F.length(digits)
    each = lambda c, k: F.when((n - k) % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), each), F.lit(0), lambda a, b: a + b)


def refill(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    step = lambda acc, c: F.when(c.between("0", "9"), F.struct(F.concat(acc["out"], F.substr(digits, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))
    return F.when(F.length(pattern) == F.length(digits), digits).otherwise(F.aggregate(F.split(pattern, ""), start, step, lambda acc: acc["out"]))


def _ten(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(19)]), (k + 1).cast("int"))


def _kind(x: Column) -> Column:
    return (
        F.when(F.contains(x, F.lit("@")) & x.rlike(f"^(?:{MAIL})$"), "mail")
        .when(x.rlike("^AKIA[0-9A-Z]{16}$"), "access")
        .when(x.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
        .when(x.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "date-")
        .when(x.rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), "date/")
        .when(x.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), "dateUS")
        .when(x.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), "date.")
        .when(x.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "social")
        .when(x.rlike("^(?:[0-9]{12,19}|(?:[0-9]{4}[ -]){3}[0-9]{1,7})$"), "card")
        .when(x.rlike(r"^[+(0-9][-+() .0-9]*$"), "phone")
        .otherwise("secret")
    )


def _ymd(kind: Column, d: Column) -> Column:
    """A date's digits as yyyyMMdd."""
    cut = lambda a, n: F.substring(d, a, n)
    return F.when(kind == "dateUS", F.concat(cut(5, 4), cut(1, 2), cut(3, 2))).when(kind == "date.", F.concat(cut(5, 4), cut(3, 2), cut(1, 2))).otherwise(d)


def _body(x: Column, kind: Column, d: Column) -> Column:
    """What each kind permutes: (kept digits before, kept digit within, the digits that move); no body if the value isn't valid.

    Cards keep their first digit (the industry) and get a new check digit. Phone numbers keep the country's code and
    leading zeros; those of ten digits in the North American form keep the first digit of area and exchange where these
    can't start with it (so what is valid moves among the valid ones).
    """
    n = F.length(d)
    american = (kind == "phone") & ((n == 10) & ~x.startswith("+") | (n == 11) & x.startswith("+1"))
    country = F.when(~x.startswith("+"), 0).when(d.rlike("^[17]"), 1).when(d.rlike(_TWO_DIGIT_COUNTRIES), 2).otherwise(3)
    rest = F.substr(d, country + 1, n)
    zeros = F.length(F.regexp_extract(rest, "^0*", 0))
    last = F.substr(d, n - 9, F.lit(10))
    fits = last.rlike("^[2-9][0-9]{2}[2-9]")
    none = F.lit("")
    return F.struct(
        F.when(kind == "card", F.substring(d, 1, 1)).when(american & fits, F.substr(d, F.lit(1), n - 10)).when(american, F.concat(F.substr(d, F.lit(1), n - 10), F.substring(last, 1, 1))).when(kind == "phone", F.substr(d, F.lit(1), country + zeros)).otherwise(none).alias("before"),
        F.when(american & ~fits, F.substring(last, 4, 1)).otherwise(none).alias("within"),
        F.when(kind == "card", F.when(n.between(12, 19), F.when(luhn_sum(d) % 10 == 0, F.substr(d, F.lit(2), n - 2))))
        .when(american & fits, last)
        .when(american, F.concat(F.substring(last, 2, 2), F.substring(last, 5, 6)))
        .when(kind == "phone", F.when(n.between(7, 15) & (n > country + zeros), F.substr(rest, zeros + 1, n)))
        .when(kind == "social", F.when(~d.rlike("^(?:000|666|9)") & ~d.rlike("^...00") & ~d.rlike("0000$"), d))
        .when(kind == "ip", F.when(F.forall(F.split(x, r"\."), lambda o: o.cast("int") <= 255), d))
        .when(kind.startswith("date"), _ymd(kind, d))
        .alias("body"),
        F.when(american & fits, "american").when(american, "ten").otherwise(kind).alias("form"),
    )


def _century(body: Column) -> Column:
    return F.substring(body, 1, 2).cast("int") * 100


def _first_day(body: Column) -> Column:
    return F.make_date(_century(body), F.lit(1), F.lit(1))


def _space(x: Column, body: Column, form: Column) -> Column:
    """(a, b, v): the value's place v among the a*b valid ones of its form; all null if it has none."""
    n, num = F.length(body), lambda a, k: F.substring(body, a, k).cast("long")
    half = F.floor(n / 2)
    first = F.floor((n - 1) / 2)
    area = num(1, 3)
    octets = F.aggregate(F.split(x, r"\."), F.lit(0).cast("long"), lambda acc, o: acc * 256 + o.cast("long"))
    day = F.try_to_timestamp(body, F.lit("yyyyMMdd")).cast("date")
    long = _century(body) % 400 == 0
    dated = form.startswith("date") & (_century(body) >= 100)
    triple = lambda a, b, v: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), v.cast("long").alias("v"))
    return (
        F.when(body.isNull(), None)
        .when(form.isin("card", "ten"), triple(_ten(half), _ten(n - half), body))
        .when(form == "american", triple(F.lit(640_000), F.lit(10_000), ((num(1, 3) - 200) * 800 + num(4, 3) - 200) * 10_000 + num(7, 4)))
        .when(form == "phone", triple(_ten(first) * 9, _ten(n - 1 - first), body.cast("long") - _ten(n - 1)))
        .when(form == "social", triple(F.lit(898 * 99), F.lit(9999), ((area - F.when(area > 666, 2).otherwise(1)) * 99 + num(4, 2) - 1) * 9999 + num(6, 4) - 1))
        .when(form == "ip", triple(F.lit(65_536), F.lit(65_536), octets))
        # 36,524 days of a century are 92 x 397, the 36,525 of one with a leap year at its start 75 x 487
        .when(dated, F.when(day.isNotNull(), triple(F.when(long, 75).otherwise(92), F.when(long, 487).otherwise(397), F.datediff(day, _first_day(body)))))
    )


def _digits_of(body: Column, form: Column, v: Column) -> Column:
    """The moved value's digits (octets with dots for addresses), as many as the body has."""
    n = F.length(body)
    area = F.floor(v / (99 * 9999)) + 1
    date = F.date_format(F.date_add(_first_day(body), v.cast("int")), "yyyyMMdd")
    pad = lambda c, k: F.lpad(c.cast("string"), k, "0")
    return (
        F.when(form.isin("card", "ten"), F.lpad(v.cast("string"), n, F.lit("0")))
        .when(form == "american", F.concat((F.floor(v / 8_000_000) + 200).cast("string"), (F.pmod(F.floor(v / 10_000), F.lit(800)) + 200).cast("string"), pad(F.pmod(v, F.lit(10_000)), 4)))
        .when(form == "phone", (v + _ten(n - 1)).cast("string"))
        .when(form == "social", F.concat(pad(area + F.when(area > 665, 1).otherwise(0), 3), pad(F.pmod(F.floor(v / 9999), F.lit(99)) + 1, 2), pad(F.pmod(v, F.lit(9999)) + 1, 4)))
        .when(form == "ip", F.concat_ws(".", *[F.pmod(F.shiftright(v, k), F.lit(256)).cast("string") for k in (24, 16, 8, 0)]))
        .when(form == "dateUS", F.concat(F.substring(date, 5, 4), F.substring(date, 1, 4)))
        .when(form == "date.", F.concat(F.substring(date, 7, 2), F.substring(date, 5, 2), F.substring(date, 1, 4)))
        .otherwise(date)
    )


def _token(key: str, kind: str, x: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), x).cast("binary"), 256)


def pseudonyms(key: str, finds: Column) -> Column:
    """What stands for each of an array of finds: its pseudonym, or itself if it isn't valid.

    A chain of passes over the array, each of which adds a few fields from those before it.
    """
    kinds = F.transform(finds, lambda x: F.struct(x.alias("x"), _kind(x).alias("kind")))
    token = F.lit("mail"), F.lit("access"), F.lit("secret")
    digits = F.transform(kinds, lambda y: F.struct(y["x"].alias("x"), y["kind"].alias("kind"), F.when(~y["kind"].isin(*token), F.regexp_replace(y["x"], "[^0-9]", "")).alias("d")))
    bodies = F.transform(digits, lambda y: F.struct(y.alias("f"), F.when(y["d"].isNotNull(), _body(y["x"], y["kind"], y["d"])).alias("p")))
    spaces = F.transform(bodies, lambda y: F.struct(y["f"].alias("f"), y["p"].alias("p"), F.when(y["p"]["body"].isNotNull(), _space(y["f"]["x"], y["p"]["body"], y["p"]["form"])).alias("s")))

    def begin(y: Column) -> Column:
        s, p = y["s"], y["p"]
        named = F.when(p["form"].startswith("date"), F.concat(F.lit("date/"), F.substring(p["body"], 1, 2))).when(p["form"].isin("american", "ip"), p["form"]).otherwise(F.concat_ws("/", p["form"], p["before"], p["within"], F.length(p["body"]).cast("string")))
        m = F.struct(s["a"].alias("a"), s["b"].alias("b"), F.concat(F.lit(f"{key}|"), named).alias("tweak"), y["f"].alias("f"), p.alias("p"))
        return F.struct(m.alias("m"), F.floor(s["v"] / s["b"]).cast("long").alias("l"), F.pmod(s["v"], s["b"]).alias("r"))

    moved = _rounds(F.transform(spaces, begin))
    values = F.transform(moved, lambda y: F.struct(y["m"]["f"].alias("f"), y["m"]["p"].alias("p"), F.when(y["l"].isNotNull(), _digits_of(y["m"]["p"]["body"], y["m"]["p"]["form"], y["l"] * y["m"]["b"] + y["r"])).alias("o")))

    def joined(y: Column) -> Column:
        f, p, o = y["f"], y["p"], y["o"]
        whole = F.when(p["form"] == "ten", F.concat(p["before"], F.substring(o, 1, 2), p["within"], F.substr(o, F.lit(3), F.lit(6)))).otherwise(F.concat(p["before"], o))
        return F.struct(f.alias("f"), F.when(f["kind"] == "card", F.concat(whole, F.pmod(10 - luhn_sum(F.concat(whole, F.lit("0"))) % 10, F.lit(10)).cast("string"))).otherwise(whole).alias("o"))

    def said(y: Column) -> Column:
        x, kind, o = y["f"]["x"], y["f"]["kind"], y["o"]
        out = (
            F.when(kind == "mail", F.concat(F.lit("user."), F.substring(_token(key, "mail", F.lower(x)), 1, 20), F.lit("@mail.invalid")))
            .when(kind == "access", F.concat(F.lit("AKIA"), F.upper(F.substring(_token(key, "access", x), 1, 16))))
            .when(kind == "secret", F.when(F.length(x) >= 6, F.substr(F.concat(_token(key, "secret", x), _token(key, "secret2", x)), F.lit(1), F.length(x))))
            .when(kind == "ip", o)
            .when(o.isNotNull(), refill(x, o))
        )
        return F.coalesce(out, x)

    return F.transform(F.transform(values, joined), said)


def pseudonymise(df: DataFrame, *, key: str | None = None, text_col: str = "text", count_col: str | None = None, find: str = ANY, replace: Callable[[str, Column], Column] = pseudonyms) -> DataFrame:
    """``df`` with the finds in ``text_col`` replaced by pseudonyms under ``key``; ``count_col``, if named, gets their number.

    One pass of one pattern over each text sets the finds off by a private character, without Python
    and without a shuffle; a text without any digit, at sign or secret's name is passed through. Cards must satisfy
    Luhn's check, octets be at most 255, dates exist, social security numbers be issuable, phone numbers have
    7 to 15 digits; what fails stays as it is, and so do all characters around the finds. Dates are read as
    yyyy-MM-dd, yyyy/MM/dd, MM/dd/yyyy or dd.MM.yyyy. The key is the caller's, or the session's setting
    ``kelpline.pseudonym.key``; without any, ValueError.

    Null texts stay null with 0 finds, empty ones empty; texts of any length take time and memory in proportion
    to their length; equal rows stay equal; an empty table stays empty; all other columns and rows stay as they are.
    """
    key = key_of(df.sparkSession, key)
    text, names = F.col(f"`{text_col}`"), set(df.columns)
    fresh = lambda n: n if n not in names else fresh(f"_{n}")
    parts, said = fresh("_parts"), fresh("_said")
    taken = F.contains(text, F.lit(_MARK)) | F.contains(text, F.lit(_ESCAPE))
    escaped = F.when(taken, F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a"))).otherwise(text)
    marked = F.regexp_replace(escaped, f"(?:{find})", f"{_MARK}$0{_MARK}")
    out = df.withColumn(parts, F.when(text.rlike(HINT), F.split(marked, _MARK, -1)))
    finds = F.filter(F.col(parts), lambda x, k: k % 2 == 1)
    out = out.withColumn(said, F.when(F.size(parts) > 1, F.struct(finds.alias("x"), replace(key, finds).alias("y"))))
    whole = F.array_join(F.transform(F.col(parts), lambda x, k: F.when(k % 2 == 1, F.get(F.col(said)["y"], F.floor(k / 2).cast("int"))).otherwise(x)), "")
    plain = F.when(taken, F.replace(F.replace(whole, F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))).otherwise(whole)
    if count_col:
        changed = F.size(F.filter(F.zip_with(F.col(said)["x"], F.col(said)["y"], lambda a, b: a != b), lambda x: x))
        out = out.withColumn(count_col, F.coalesce(F.when(F.col(said).isNotNull(), changed), F.lit(0)).cast("long"))
    return out.withColumn(text_col, F.when(F.col(said).isNotNull(), plain).otherwise(text)).drop(parts, said)
