"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates are found by pattern, validated (Luhn, mod 97, octets,
calendar, numbering plan) and replaced by another valid value of the same
format; e-mail names and credentials are permuted letter for letter and digit
for digit. Each kind is a permutation under the key, so equal values get equal
pseudonyms in every document, and unequal ones unequal pseudonyms.

A value is a pair (x, y) out of Z_a x Z_b. Rounds add to one half a keyed hash
(SHA-256) of the other, modulo its size: a bijection for any a and b, with no
cycle walking. The rounds are run, the pair is counted on by one as a number of
all a * b, and the rounds are undone. So no value is its own pseudonym, and who may
ask for pseudonyms of pseudonyms comes back to a value only after going through
all values of its form. Names are treated alike, as numbers written in letters
and digits. The key comes from the session's settings or from a secret kept in the
shared folder (``key_of``), never from the code.

Everything is SQL expressions. Texts without a digit, ``@`` or the words before
a credential are passed through after one scan; null texts stay null. Values that fail validation stay.
Very long texts are gone through whole; an empty table gives no row; null and repeated ids and
other columns pass through.
"""

from __future__ import annotations

import secrets

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.session import shared_dir

ROUNDS = 8

# Countries by the length of their IBANs.
IBAN = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_form(n: int, countries: str) -> str:
    """Compact, or in groups of four and a rest."""
    fours, rest = divmod(n - 4, 4)
    groups = f"(?:[ -][A-Z0-9]{{4}}){{{fours}}}" + (f"[ -][A-Z0-9]{{{rest}}}" if rest else "")
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|{groups})"


IBAN_FORM = f"(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{1,20}}[0-9]{{10}}|{'|'.join(_iban_form(n, c) for n, c in IBAN.items())})"

# Groups of card numbers. The odd ones end where no other number goes on.
CARD_ODD = ((4, 4, 4, 4, 3), (4, 4, 4, 4, 2), (4, 4, 4, 4, 1), (4, 4, 4, 3), (4, 4, 4, 2), (4, 4, 4, 1), (4, 4, 5), (4, 6, 4), (4, 5, 6), (4, 3, 3, 3), (6, 13), (6, 10))


def _groups(*sizes: int) -> str:
    return "[ -]".join(f"[0-9]{{{n}}}" for n in sizes)


CARD_FORM = f"(?:[0-9]{{13,19}}|(?:{'|'.join(_groups(*g) for g in CARD_ODD)})(?![ ./-]?[0-9])|{_groups(4, 4, 4, 4)}|{_groups(4, 6, 5)})"

# Patterns by kind, tried in this order at each place.
KINDS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|(?<=\bpassword=)[^\s\"'&;]{6,}|(?<=\b(?:token|secret|api_key) = \")[^\"\s]{16,}(?=\")",
    "date": r"(?<![0-9/-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9/-])|(?<![0-9/-])(?<![0-9]\.)[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9/-])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "iban": r"\b(?=[A-Z]{2}[0-9]{2}[A-Z0-9 -])" + IBAN_FORM + r"\b",
    "phone": r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
             r"|(?<![0-9+])\+[2-9](?:(?:[ .-]?\((?=[0-9]{1,4}\))|\)[ .-]?|[ .-](?=[0-9]{2}|[0-9][ .-][0-9]{2}))?[0-9]){7,14}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": "(?<![0-9])" + CARD_FORM + "(?![0-9])",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
# Held by every text that PATTERN matches anything in.
FIRST = r"[0-9@]|password=|AKIA|(?:token|secret|api_key) = \""


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _sub(s: Column, start: Column | int, n: Column | int) -> Column:
    return F.substring(s, F.lit(start), F.lit(n))


def _refill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by those of ``digits``."""
    return F.array_join(F.transform(F.split(layout, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), _sub(digits, F.length(_digits(_sub(layout, 1, i + 1))), 1)).otherwise(c)), "")


def _pad(n: Column, width: Column) -> Column:
    return F.lpad(n.cast("string"), width, F.lit("0"))


def _hash(key: Column, *parts: Column) -> Column:
    """SHA-256, in hex, of the parts with the key before and behind."""
    return F.sha2(F.concat_ws("|", key, *[p.cast("string") for p in parts], key), 256)


def _number(hexed: Column) -> Column:
    return F.conv(_sub(hexed, 1, 15), 16, 10).cast("long")


def _rounds(start: Column, forward, back, turn) -> Column:
    """Run ROUNDS rounds, ``turn`` once, and undo the rounds."""
    def step(s: Column, r: Column) -> Column:
        return F.when(r < ROUNDS, forward(s, r)).when(r == ROUNDS, turn(s)).otherwise(back(s, 2 * ROUNDS - r))
    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS)), start, step)


def permute(x: Column, y: Column, a: Column, b: Column, key: Column, tag: Column) -> Column:
    """Struct (x, y): the pseudonym of (x, y) in Z_a x Z_b, never the pair itself (a * b >= 2)."""
    a, b = a.cast("long"), b.cast("long")

    def pair(px: Column, py: Column) -> Column:
        return F.struct(px.cast("long").alias("x"), py.cast("long").alias("y"))

    def round_(sign: int):
        return lambda s, r: F.when(r % 2 == 0, pair(F.pmod(s["x"] + sign * F.pmod(_number(_hash(key, tag, r, s["y"])), a), a), s["y"])) \
            .otherwise(pair(s["x"], F.pmod(s["y"] + sign * F.pmod(_number(_hash(key, tag, r, s["x"])), b), b)))

    return _rounds(pair(x, y), round_(1), round_(-1),
                   lambda s: pair(F.pmod(s["x"] + F.when(s["y"] == b - 1, 1).otherwise(0), a), F.pmod(s["y"] + 1, b)))


def _shift(s: Column, by: Column, sign: int) -> Column:
    """Each digit and letter of ``s`` moved within its class by the hex pairs of ``by``."""
    def one(c: Column, i: Column) -> Column:
        v = sign * F.conv(_sub(by, 1 + 2 * (i % 32), 2), 16, 10).cast("int")
        moved = [F.when(c.rlike(f"^[{lo}-{hi}]$"), F.chr(F.pmod(F.ascii(c) - ord(lo) + v, F.lit(ord(hi) - ord(lo) + 1)) + ord(lo)))
                 for lo, hi in (("0", "9"), ("a", "z"), ("A", "Z"))]
        return F.coalesce(*moved, c)
    return F.array_join(F.transform(F.split(s, ""), one), "")


def scramble(s: Column, key: Column, tag: str) -> Column:
    """Pseudonym of a name: a permutation of the strings of the same length and
    character classes, without fixed points where ``s`` has an ASCII letter or digit."""
    half = F.ceil(F.length(s) / 2).cast("int")

    def pair(px: Column, py: Column) -> Column:
        return F.struct(px.alias("x"), py.alias("y"))

    def round_(sign: int):
        return lambda s, r: F.when(r % 2 == 0, pair(_shift(s["x"], _hash(key, F.lit(tag), r, s["y"]), sign), s["y"])) \
            .otherwise(pair(s["x"], _shift(s["y"], _hash(key, F.lit(tag), r, s["x"]), sign)))

    def turn(s: Column) -> Column:
        # counted on by one: the last digit or letter that is not the highest of its class goes up, those behind it start anew
        def on(w: Column) -> Column:
            tail = F.regexp_extract(w, "(?s)[^0-8A-Ya-y]*$", 0)
            head = F.length(w) - F.length(tail)
            up = F.when(head > 0, F.chr(F.ascii(_sub(w, head, 1)) + 1)).otherwise(F.lit(""))
            return F.concat(_sub(w, 1, head - 1), up, F.translate(tail, "9zZ", "0aA"))
        return _let(on(F.concat(s["x"], s["y"])), lambda w: pair(_sub(w, 1, half), F.substring(w, half + 1, F.length(w))))

    out = _rounds(pair(_sub(s, 1, half), F.substring(s, half + 1, F.length(s))), round_(1), round_(-1), turn)
    return _let(out, lambda o: F.concat(o["x"], o["y"]))


def _halves(digits: Column, n: Column, key: Column, tag: str) -> Column:
    """Pseudonym of ``n`` digits (2 to 18), as digits."""
    left = F.floor(n / 2).cast("int")
    right = (n - left).cast("int")
    out = permute(_sub(digits, 1, left), _sub(digits, left + 1, right),
                  F.pow(F.lit(10), left), F.pow(F.lit(10), right), key, F.concat(F.lit(tag), n.cast("string")))
    return _let(out, lambda o: F.concat(_pad(o["x"], left), _pad(o["y"], right)))


def _luhn(digits: Column, double_last: bool) -> Column:
    """Luhn sum modulo 10; ``double_last``: of a payload without its check digit."""
    def add(s: Column, i: Column) -> Column:
        d = _sub(digits, F.length(digits) - i, 1).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return (s + F.when((i % 2 == 0) == F.lit(double_last), twice).otherwise(d)) % 10
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _card(m: Column, key: Column) -> Column:
    """13 to 19 digits with a right check digit: the first digit stays, the check digit
    is made anew. Of grouped digits that are none, the longest groups from the first
    that are one; what follows stays."""
    def of(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(_sub(d, 1, 1), _halves(_sub(d, 2, n - 2), n - 2, key, "card"))
        return _let(body, lambda b: F.concat(b, F.pmod(-_luhn(b, True), F.lit(10)).cast("string")))

    def right(c: Column) -> Column:
        return _let(_digits(c), lambda d: (F.length(d) >= 13) & (_luhn(d, False) == 0) & ~d.rlike("^0+$"))

    ends = F.filter(F.sequence(F.length(m), F.lit(13), F.lit(-1)), lambda e: (e == F.length(m)) | _sub(m, e + 1, 1).rlike("[ -]"))
    best = F.get(F.filter(F.transform(ends, lambda e: _sub(m, 1, e)), right), 0)
    return _let(best, lambda c: F.when(c.isNotNull(), F.concat(_refill(c, _let(_digits(c), of)), F.substring(m, F.length(c) + 1, F.length(m)))))


def _phone(m: Column, key: Column) -> Column:
    """North American numbers keep country, first area and first exchange digit; others all but the last seven."""
    def of(d: Column) -> Column:
        n = F.length(d)
        ten = _sub(d, n - 9, 10)
        free = _halves(F.concat(_sub(ten, 2, 2), _sub(ten, 5, 6)), F.lit(8), key, "nanp")
        na = _let(free, lambda f: F.concat(_sub(d, 1, n - 10), _sub(ten, 1, 1), _sub(f, 1, 2), _sub(ten, 4, 1), _sub(f, 3, 6)))
        far = F.concat(_sub(d, 1, n - 7), _halves(_sub(d, n - 6, 7), F.lit(7), key, "phone"))
        return _let(F.when(m.rlike(r"^\+[2-9]"), far).otherwise(na), lambda f: _refill(m, f))
    return _let(_digits(m), of)


def _ssn(m: Column, key: Column) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = _sub(m, 1, 3).cast("int"), _sub(m, 5, 2).cast("int"), _sub(m, 8, 4).cast("int")
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1
    out = permute(index, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"))

    def text(o: Column) -> Column:
        k = F.floor(o["x"] / 99)
        return F.concat_ws("-", _pad(F.when(k >= 665, k + 2).otherwise(k + 1), F.lit(3)), _pad(o["x"] % 99 + 1, F.lit(2)), _pad(o["y"] + 1, F.lit(4)))
    return F.when(valid, _let(out, text))


def _mod97(s: Column) -> Column:
    """The value of digits and letters (A is 10) modulo 97."""
    def add(r: Column, i: Column) -> Column:
        c = _sub(s, i, 1)
        return F.when(c.rlike("^[0-9]$"), (r * 10 + c.try_cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)


def _iban(m: Column, key: Column) -> Column:
    """Country, letters and all but the last ten digits stay; the check digits are made anew.
    With fewer than two digits, digits and letters are moved within their class."""
    def of(c: Column) -> Column:
        rest = F.substring(c, F.lit(5), F.length(c))
        digits = _digits(rest)

        def last(d: Column) -> Column:
            k = F.least(F.length(d), F.lit(10))
            return F.concat(_sub(d, 1, F.length(d) - k), _halves(F.substring(d, F.length(d) - k + 1, k), k, key, "iban"))
        body = F.when(F.length(digits) >= 2, _let(digits, lambda d: _refill(rest, last(d)))).otherwise(scramble(rest, key, "iban"))
        full = _let(body, lambda b: F.concat(_sub(c, 1, 2), _pad(98 - _mod97(F.concat(b, _sub(c, 1, 2), F.lit("00"))), F.lit(2)), b))
        return F.when(_mod97(F.concat(rest, _sub(c, 1, 4))) == 1, _let(full, lambda f: _layout(m, f)))
    return _let(F.regexp_replace(m, "[ -]", ""), of)


def _layout(m: Column, s: Column) -> Column:
    """``s`` with the separators of ``m``."""
    return F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike("^[A-Z0-9]$"), _sub(s, F.length(
        F.regexp_replace(_sub(m, 1, i + 1), "[ -]", "")), 1)).otherwise(c)), "")


def _ipv4(m: Column, key: Column) -> Column:
    part = F.split(m, r"\.")
    valid = F.forall(part, lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]"))

    def half(i: int) -> Column:
        return F.get(part, i).cast("int") * 256 + F.get(part, i + 1).cast("int")
    out = permute(half(0), half(2), F.lit(65536), F.lit(65536), key, F.lit("ipv4"))
    return F.when(valid, _let(out, lambda o: F.concat_ws(".", *[
        v.cast("long").cast("string") for h in ("x", "y") for v in (F.floor(o[h] / 256), o[h] % 256)])))


DAYS = (189, 773)  # 189 * 773 = 146,097: the days of 400 years, 1700 to 2099


def _date(m: Column, key: Column) -> Column:
    """Calendar dates of 1700 to 2099: year first, else day first, else month first."""
    a, b = DAYS
    zero = F.lit("1700-01-01").cast("date")

    def of(order: tuple[int, int, int]):
        """(start of year, month, day) within the ten characters."""
        y, mo, d = order
        day = F.concat_ws("-", _sub(m, y, 4), _sub(m, mo, 2), _sub(m, d, 2)).try_cast("date")
        n = F.datediff(day, zero)
        out = permute(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, F.lit("date"))
        new = _let(out, lambda o: F.date_add(zero, (o["x"] * b + o["y"]).cast("int")))
        sep = _sub(m, 5 if y == 1 else 3, 1)
        parts = {y: F.year, mo: F.month, d: F.dayofmonth}

        def written(t: Column) -> Column:
            first, second, third = (_pad(parts[at](t), F.lit(4 if at == y else 2)) for at in sorted(order))
            return F.concat(first, sep, second, sep, third)
        return F.when((n >= 0) & (n < a * b), _let(new, written))

    return F.when(m.rlike("^[0-9]{4}-"), of((1, 6, 9))).otherwise(F.coalesce(of((7, 4, 1)), of((7, 1, 4))))


def _email(m: Column, key: Column) -> Column:
    at = F.instr(m, "@")
    return F.concat(scramble(_sub(m, 1, at - 1), key, "email"), F.substring(m, at, F.length(m)))


def _secret(m: Column, key: Column) -> Column:
    keep = F.when(m.startswith("AKIA"), 4).otherwise(0)
    return F.concat(_sub(m, 1, keep), scramble(F.substring(m, keep + 1, F.length(m)), key, "secret"))


def _kind(m: Column) -> Column:
    """The kind of a match of PATTERN, by its form."""
    forms = {"email": "@", "date": r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$", "ipv4": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
             "iban": f"^{IBAN_FORM}$", "ssn": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
             "card": f"^{CARD_FORM}$", "phone": r"^(?:[+(]?[0-9][0-9() .+-]{8,}|\+[2-9][0-9() .-]{7,})$"}
    out = F.lit("secret")
    for kind, form in reversed(forms.items()):
        out = F.when(m.rlike(form), F.lit(kind)).otherwise(out)
    return out


def pseudonym(kind: Column, m: Column, key: Column) -> Column:
    """The pseudonym of a match, null if it fails validation."""
    out = F.lit(None).cast("string")
    for name, f in (("card", _card), ("phone", _phone), ("ssn", _ssn), ("iban", _iban), ("ipv4", _ipv4),
                    ("date", _date), ("email", _email), ("secret", _secret)):
        out = F.when(kind == name, f(m, key)).otherwise(out)
    return out


KEY = "comptoir.pii.key"


def key_of(spark: SparkSession) -> str:
    """The key: the session's setting ``comptoir.pii.key``, else a random secret that is made once in the
    shared folder and stays there, so that runs which share the folder share their pseudonyms."""
    key = spark.conf.get(KEY, None)
    if key:
        return key
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/secrets/pii.key")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        try:
            out = fs.create(path, False)
            out.write(bytearray(secrets.token_hex(32).encode()))
            out.close()
        except Py4JJavaError:
            if not fs.exists(path):  # else another run made it meanwhile
                raise
    lines = jvm.org.apache.commons.io.IOUtils.toString(fs.open(path), "UTF-8")
    if len(lines) != 64:
        raise ValueError(f"{path.toString()} holds no key")
    return lines


def pseudonymise(docs: DataFrame, key: str, text: str = "text", mark: str | None = "pii") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and in the column ``mark`` (if
    any) an array of (kind, pseudonym) in order of appearance, empty if there is
    none. Other columns stay; an input column named ``mark`` is replaced."""
    k = F.lit(key)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text"))
    found = F.when(F.col("_text").rlike(FIRST), F.regexp_extract_all(F.col("_text"), F.lit(PATTERN), F.lit(0)))
    d = d.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    d = d.withColumn("_new", F.transform("_found", lambda m: F.struct(
        m.alias("old"), _let(_kind(m), lambda kind: F.struct(kind.alias("kind"), pseudonym(kind, m, k).alias("value"))).alias("p"))))
    new = F.col("_new")
    between = F.split(F.col("_text"), PATTERN, -1)
    whole = F.array_join(F.zip_with(between, new, lambda gap, x: F.concat(gap, F.coalesce(x["p"]["value"], x["old"], F.lit("")))), "")
    d = d.withColumn("_out", F.when(F.exists(new, lambda x: x["p"]["value"].isNotNull()), whole).otherwise(F.col("_text")))
    pii = F.transform(F.filter(new, lambda x: x["p"]["value"].isNotNull()), lambda x: F.struct(x["p"]["kind"].alias("kind"), x["p"]["value"].alias("pseudonym")))
    kept = [(F.col("_out") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns if mark is None or c.lower() != mark]
    return d.select(*kept, *([pii.alias(mark)] if mark else []))
