"""Format-preserving pseudonyms for personal data, by keyed Feistel networks.

A value that is found and validated is replaced by another of the same format:
a card number by a card number with a right check digit, an IBAN by one with
right check digits, a date by a date, an address or e-mail by one of the same
shape. The replacement depends on the key and the value alone, so a value has
the same pseudonym in every document, and different values have different ones
(each network is a permutation of its format).

The network works on a list of digits with a radix each. In each round one
half of the list is shifted, digit by digit and modulo its radix, by a keyed
hash of the other half; the halves take turns. Digits, letters and separators
map as follows: 0-9 radix 10, a-z and A-Z radix 26 each, the accented letters
of Latin-1 within their runs, anything else stays. A date is its day number in
the 400 years from 1800 (146,097 = 189 x 773 days, two digits), an IPv4
address four digits of radix 256, a hex token digits of radix 16.

Everything is a column expression: the text is cut at the places where a value
may start. At each place the possible extents are tried, the likeliest first
(a card's printed groups, an IBAN's length by country, a phone number that
ends where another value starts), and the first valid one counts; the values
taken from left to right are replaced and the pieces joined again.

Edges: null text stays null, empty text stays empty, with no findings; values
that fail their validation (check digits, calendar, octets, length) stay as
they are; repeated values and rows get equal pseudonyms; texts of any length
are scanned whole. A permutation may map a value to itself, with probability
one in the size of its format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import let

ROUNDS = 10
#: Places of a text that are gone through at a time.
_BLOCK = 256

# Runs of code points that are shifted within themselves.
RUNS = [(48, 10), (65, 26), (97, 26), (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8)]

# Kind -> (what may not or must stand before, the value); no letter or digit
# may follow. A place is where a value of any kind may start.
_ALONE = "(?<![\\p{L}\\p{N}])"
_END = "(?![\\p{L}\\p{N}])"
PATTERNS = {
    # 64 characters before the @, 126 labels of 63 behind it, at most.
    "email": (_ALONE, "[\\p{L}\\p{N}][\\p{L}\\p{N}._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\\.){1,126}[A-Za-z]{2,63}+"),
    "secret": ("(?<=[\"'=: ])", "(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})"),
    "iban": (_ALONE, "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"),
    "ipv4": ("(?<![\\p{L}\\p{N}.])", "[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?!\\.[0-9])"),
    "date": (_ALONE, "(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\\.[0-9]{2}\\.[0-9]{4})"),
    "ssn": (_ALONE, "[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "phone": ("", "(?:\\+[0-9]{1,3}[ .-]?\\(?[0-9]{2,4}\\)?(?:[ .-]?[0-9]{2,4}){2,3}"
                  "|\\([0-9]{3}\\) ?[0-9]{3}-[0-9]{4}|(?<![\\p{L}\\p{N}])[0-9]{3}-[0-9]{3}-[0-9]{4})"),
    "card": (_ALONE, "[0-9](?:[ -]?[0-9]){12,18}"),
}
PLACE = "(?:" + "|".join(f"{b}(?=(?:{p}){_END})" for b, p in PATTERNS.values()) + ")"
#: The text from a place on, as far as a value there may reach.
WINDOW = f"{PLACE}(?=({PATTERNS['email'][1]}{_END}|(?s:.{{1,80}})))"

# Length of an IBAN by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG YE", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}
# The printed shapes of a card number: unbroken, or in groups.
_CARDS = ["[0-9]{13,19}", "[0-9]{4}(?:[ -][0-9]{4}){3}", "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}",
          "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}"]
# What is a value of its own after a phone number's separator; groups of four
# that go on may have the card later.
_OTHER = "(?:" + "|".join([PATTERNS[k][1] for k in ("ipv4", "date", "ssn")] + _CARDS[:1] + [
    _CARDS[1] + "(?![ -][0-9]{4}(?![0-9]))", _CARDS[2], "[0-9]{3}-[0-9]{3}-[0-9]{4}", "[0-9]{1,2}/[0-9]{2}(?:[0-9]{2})?"]) + f"){_END}"
_GROUP = f"(?:[ .-](?!{_OTHER}))?[0-9]{{2,4}}"


def _iban_groups(n: int) -> str:
    rest = f"(?: ?[A-Z0-9]{{{n % 4}}})" if n % 4 else ""
    return f"[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}"


#: What a value of a kind may be at a place, the likeliest first; the first
#: that is valid counts. Other kinds have one pattern of a fixed extent.
ALTERNATIVES = {
    "iban": ["(?:" + "|".join(f"(?:{c.replace(' ', '|')}){_iban_groups(n)}" for n, c in _IBAN_LENGTHS.items()) + ")",
             *[f"[A-Z]{{2}}{_iban_groups(n)}" for n in range(35, 11, -1)]],
    "phone": ["\\+1[ .-]?\\(?[0-9]{3}\\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}",
              *[f"\\+[0-9]{{1,3}}[ .-]?\\(?[0-9]{{2,4}}\\)?{_GROUP}{_GROUP}{more}" for more in (f"(?:{_GROUP})?", "")],
              PATTERNS["phone"][1], "\\+[0-9]{1,3}[ .-]?\\(?[0-9]{2,4}\\)?(?:[ .-]?[0-9]{2,4}){2}"],
    "card": _CARDS + [f"[0-9](?:[ -]?[0-9]){{{n - 1}}}" for n in range(19, 12, -1)],
}


def _shifts(half: Column, other: Column, n_before: Column, key: str, tweak: Column, rnd: Column) -> Column:
    """``half`` shifted, digit by digit, by a keyed hash of ``other``."""
    seed = F.concat_ws("|", F.lit(key), tweak, rnd.cast("string"),
                       F.array_join(F.transform(other, lambda x: x["d"].cast("string")), ","))
    return let(seed, lambda s: F.transform(half, lambda x, i: F.struct(
        F.pmod(x["d"] + F.conv(F.substring(F.sha2(F.concat_ws("|", s, (i + n_before).cast("string")), 256), 1, 12),
                               16, 10).cast("bigint"), x["r"]).alias("d"), x["r"].alias("r"))))


def feistel(digits: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of an array of (d, r) structs, 0 <= d < r, longs. The
    digit counts of the halves differ by one at most; a single digit is only
    shifted by the key."""
    def step(a: Column, rnd: Column) -> Column:
        cut = F.floor(F.size(a) / 2).cast("int")
        left, right = F.slice(a, 1, cut), F.slice(a, cut + 1, F.size(a) - cut)
        return F.when(rnd % 2 == 0, F.concat(left, _shifts(right, left, cut, key, tweak, rnd))) \
            .otherwise(F.concat(_shifts(left, right, F.lit(0), key, tweak, rnd), right))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), digits, step)


def _pair(d: Column, r) -> Column:
    r = F.lit(r) if isinstance(r, int) else r
    return F.struct(d.cast("bigint").alias("d"), r.cast("bigint").alias("r"))


# Start and size of the run of each Latin-1 code point (itself
# and 1 where it has none), as SQL arrays that a row's characters index.
_RUN = [next(((a, n) for a, n in RUNS if a <= c < a + n), (c, 1)) for c in range(256)]
_STARTS = "array(" + ",".join(f"{a}L" for a, _ in _RUN) + ")"
_SIZES = "array(" + ",".join(f"{n}L" for _, n in _RUN) + ")"


def _codes(s: Column) -> Column:
    """Characters of ``s`` as (s, c: code point, d: place in its run, r: size
    of the run); r is 1 for a character that stays."""
    def one(x: Column) -> Column:
        c = F.ascii(x)
        return F.struct(x.alias("s"), c.cast("bigint").alias("c"),
                        (c - F.coalesce(F.get(F.expr(_STARTS), c), c)).cast("bigint").alias("d"),
                        F.coalesce(F.get(F.expr(_SIZES), c), F.lit(1)).cast("bigint").alias("r"))
    return F.transform(F.filter(F.split(s, ""), lambda x: x != ""), one)


def permute_text(s: Column, key: str, tweak: str) -> Column:
    """``s`` with each letter or digit moved within its run; the rest stays."""
    def body(cs: Column) -> Column:
        moved = feistel(F.transform(F.filter(cs, lambda x: x["r"] > 1), lambda x: _pair(x["d"], x["r"])),
                        key, F.lit(tweak))
        return let(moved, lambda m: F.aggregate(
            cs, F.struct(F.lit(0).alias("i"), F.lit("").alias("o")),
            lambda a, x: F.when(x["r"] == 1, F.struct(a["i"].alias("i"), F.concat(a["o"], x["s"]).alias("o")))
            .otherwise(F.struct((a["i"] + 1).alias("i"), F.concat(
                a["o"], _letter(x["c"] - x["d"] + F.get(m, a["i"])["d"])).alias("o"))),
            lambda a: a["o"]))
    return let(_codes(s), body)


def _letter(code: Column) -> Column:
    """The character of a Latin-1 code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, the last digit counted singly."""
    return F.aggregate(
        F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                    lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""
    return F.aggregate(
        F.filter(F.split(shape, ""), lambda c: c != ""),
        F.struct(F.lit(1).alias("i"), F.lit("").alias("o")),
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct((a["i"] + 1).alias("i"), F.concat(
            a["o"], F.substring(digits, a["i"], F.lit(1))).alias("o")))
        .otherwise(F.struct(a["i"].alias("i"), F.concat(a["o"], c).alias("o"))),
        lambda a: a["o"])


def _card(s: Column, key: str) -> Column:
    def body(d: Column) -> Column:
        payload = permute_text(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        full = let(payload, lambda p: F.concat(
            p, F.pmod(F.lit(10) - _luhn_sum(F.concat(p, F.lit("0"))) % 10, F.lit(10)).cast("string")))
        return F.when(_luhn_sum(d) % 10 == 0, let(full, lambda f: _refill(s, f)))
    return let(_digits(s), body)


def _mod97(s: Column) -> Column:
    """Remainder by 97 of a string of digits and capitals (A = 10 .. Z = 35)."""
    return F.aggregate(_codes(s), F.lit(0).cast("bigint"), lambda a, x: F.when(
        x["c"] < 58, (a * 10 + x["c"] - 48) % 97).otherwise((a * 100 + x["c"] - 55) % 97))


def _iban(s: Column, key: str) -> Column:
    def body(c: Column) -> Column:
        country, rest = F.substring(c, 1, 2), F.substring(c, F.lit(5), F.length(c) - 4)
        new = permute_text(rest, key, "iban")
        full = let(new, lambda r: F.concat(country, F.lpad((98 - _mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))
        spaced = let(full, lambda f: F.when(
            s.contains(" "), F.trim(F.regexp_replace(f, "(.{4})", "$1 "))).otherwise(f))
        return F.when(_mod97(F.concat(rest, F.substring(c, 1, 4))) == 1, spaced)
    return let(F.translate(s, " ", ""), body)


def _date(s: Column, key: str) -> Column:
    """Year first with dashes; else day first, or month first where only that
    is a date."""
    parts = lambda y, m, d: F.try_make_timestamp_ntz(
        F.substring(s, y, 4).cast("int"), F.substring(s, m, 2).cast("int"), F.substring(s, d, 2).cast("int"),
        F.lit(0), F.lit(0), F.lit(0)).cast("date")
    out = F.when(s.substr(5, 1) == "-", _moved_date(parts(1, 6, 9), "yyyy-MM-dd", key))
    for sep in "/.":
        day_first = _moved_date(parts(7, 4, 1), f"dd'{sep}'MM'{sep}'yyyy", key)
        month_first = _moved_date(parts(7, 1, 4), f"MM'{sep}'dd'{sep}'yyyy", key)
        out = out.when(s.substr(3, 1) == sep, F.coalesce(day_first, month_first) if sep == "/" else day_first)
    return out


def _moved_date(d: Column, pattern: str, key: str) -> Column:
    n = F.datediff(d, F.lit("1800-01-01").cast("date"))
    moved = feistel(F.array(_pair(F.floor(n / 773), 189), _pair(n % 773, 773)), key, F.lit("date"))
    day = let(moved, lambda m: (F.get(m, F.lit(0))["d"] * 773 + F.get(m, F.lit(1))["d"]).cast("int"))
    return F.when((n >= 0) & (n < 189 * 773), F.date_format(
        F.date_add(F.lit("1800-01-01").cast("date"), day), pattern))


def _ipv4(s: Column, key: str) -> Column:
    octets = F.transform(F.split(s, "\\."), lambda x: x.cast("int"))
    moved = feistel(F.transform(octets, lambda x: _pair(x, 256)), key, F.lit("ipv4"))
    return F.when(~F.exists(octets, lambda x: x > 255),
                  F.array_join(F.transform(moved, lambda x: x["d"].cast("string")), "."))


def _ssn(s: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    a, g, n = (F.substring(s, i, k).cast("int") for i, k in ((1, 3), (5, 2), (8, 4)))
    moved = feistel(F.array(_pair(a - F.when(a > 666, 2).otherwise(1), 898), _pair(g - 1, 99), _pair(n - 1, 9999)),
                    key, F.lit("ssn"))
    area = lambda m: F.get(m, F.lit(0))["d"] + 1
    text = let(moved, lambda m: F.format_string(
        "%03d-%02d-%04d", area(m) + F.when(area(m) >= 666, 1).otherwise(0),
        F.get(m, F.lit(1))["d"] + 1, F.get(m, F.lit(2))["d"] + 1))
    return F.when((a > 0) & (a < 900) & (a != 666) & (g > 0) & (n > 0), text)


def _phone(s: Column, key: str) -> Column:
    """The country code stays; 8 to 15 digits (E.164)."""
    code = F.regexp_extract(s, "^\\+[0-9]{1,3}(?=[ .(-])|^\\+[0-9]", 0)
    rest = F.substring(s, F.length(code) + 1, F.length(s))
    return F.when(F.length(_digits(s)).between(8, 15),
                  F.concat(code, permute_text(rest, key, "phone")))


def _email(s: Column, key: str) -> Column:
    """The part before the @ moves; the domain stays."""
    return F.concat(permute_text(F.substring_index(s, "@", 1), key, "email"), F.lit("@"),
                    F.substring_index(s, "@", -1))


def _secret(s: Column, key: str) -> Column:
    def body(cs: Column) -> Column:
        moved = feistel(F.transform(cs, lambda x: _pair(F.conv(x["s"], 16, 10), 16)), key, F.lit("secret"))
        hexed = F.array_join(F.transform(moved, lambda x: F.hex(x["d"])), "")
        return F.when(s == F.lower(s), F.lower(hexed)).otherwise(hexed)
    return let(_codes(s), body)


_MOVES = {"email": _email, "secret": _secret, "iban": _iban, "ipv4": _ipv4, "date": _date,
          "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(window: Column, before: Column, key: str) -> Column:
    """Struct (kind, value, pseudonym, loose) of the value at the start of
    ``window``, the text from a place on; null if none is valid. ``before`` is
    the text up to the place. Kinds are tried in the order of PATTERNS and the
    alternatives of a kind in theirs. ``loose``: a card number in no printed
    shape after another number, which may be that one's middle."""
    def named(kind: str) -> Column:
        behind, whole = PATTERNS[kind]
        some = F.array(*[F.regexp_extract(window, f"^(?:{p}){_END}", 0) for p in ALTERNATIVES.get(kind, [whole])])
        starts = window.rlike(f"^(?:{whole}){_END}")
        if kind in ("secret", "ipv4"):
            starts = starts & F.concat(before, F.lit("0")).rlike(f"{behind}0$")
        loose = F.lit(False) if kind != "card" else before.rlike("[0-9][ -]$")
        tried = F.transform(F.array_distinct(F.filter(some, lambda v: v != "")), lambda v: F.struct(
            F.lit(kind).alias("kind"), v.alias("value"), _MOVES[kind](v, key).alias("pseudonym"),
            (loose & ~v.rlike("^(?:" + "|".join(_CARDS) + ")$")).alias("loose")))
        return F.when(starts, F.get(F.filter(tried, lambda x: x["pseudonym"].isNotNull()), F.lit(0)))
    return F.coalesce(*map(named, PATTERNS))


def _chosen(pieces: Column, at: Column) -> Column:
    """For each piece (skip: its characters that belong to a value, taken:
    whether a value is replaced at its start), from left to right: the values
    ``at`` the pieces' starts that overlap none before. A loose one must
    follow a value directly."""
    def step(a: Column, x: Column) -> Column:
        free = (a["until"] <= a["pos"]) & (~x["loose"] | (a["pos"] - a["until"] <= 1))
        taken = F.coalesce(x["reach"].isNotNull() & free, F.lit(False))
        until = F.when(taken, a["pos"] + x["reach"]).otherwise(a["until"])
        skip = F.least(F.greatest(until - a["pos"], F.lit(0)), x["n"])
        return F.struct((a["pos"] + x["n"]).alias("pos"), until.alias("until"), F.concat(
            a["out"], skip.cast("string"), F.when(taken, "t").otherwise("f"), F.lit(",")).alias("out"))

    def block(a: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(a["pos"].alias("pos"), a["until"].alias("until"), F.lit("").alias("out")), step)
        return let(inner, lambda i: F.struct(
            i["pos"].alias("pos"), i["until"].alias("until"), F.concat(a["out"], i["out"]).alias("out")))

    sizes = F.transform(pieces, lambda x, i: F.struct(
        F.length(x).alias("n"), F.length(F.get(at, i)["value"]).alias("reach"), F.get(at, i)["loose"].alias("loose")))
    # What is found is gathered as text, by blocks: an array that grows by an
    # element at each place would be copied at each.
    blocks = let(sizes, lambda xs: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _BLOCK).cast("int")), lambda i: F.slice(xs, i * _BLOCK + 1, _BLOCK)))
    start = F.struct(F.lit(0).alias("pos"), F.lit(-10).alias("until"), F.lit("").alias("out"))
    found = F.aggregate(blocks, start, block, lambda a: a["out"])
    return F.transform(F.filter(F.split(found, ","), lambda x: x != ""), lambda x: F.struct(
        F.regexp_extract(x, "[0-9]+", 0).cast("int").alias("skip"), x.endswith("t").alias("taken")))


def pseudonymise(df: DataFrame, key: str, text: str = "text", found: str = "pii") -> DataFrame:
    """``df`` with ``text`` rewritten, plus the column ``found``: array of (kind,
    pseudonym) structs in the order of the text. The key is a secret of the
    caller; the same key gives the same pseudonyms in every run."""
    t = F.col(text)
    windows, cut = F.col("_pii_windows"), F.split(t, PLACE, -1)
    # One piece before the first place, also an empty one, then one a place.
    pieces = F.when(F.size(windows) > 0, let(cut, lambda x: F.when(
        F.size(x) > F.size(windows), x).otherwise(F.concat(F.array(F.lit("")), x))))
    work = df.withColumn("_pii_windows", F.when(
        t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(WINDOW), F.lit(1))))
    work = work.withColumn("_pii_pieces", pieces)
    pieces = F.col("_pii_pieces")
    # The first piece starts at no place.
    work = work.withColumn("_pii_at", F.transform(pieces, lambda _, i: F.when(i > 0, let(
        F.substring(F.get(pieces, i - 1), -2, 2), lambda b: pseudonym(F.get(windows, i - 1), b, key)))))
    work = work.withColumn("_pii_new", _chosen(pieces, F.col("_pii_at")))
    at, new = F.col("_pii_at"), F.col("_pii_new")
    valid = F.filter(at, lambda x, i: F.get(new, i)["taken"])
    joined = F.array_join(F.transform(pieces, lambda x, i: F.concat(
        F.when(F.get(new, i)["taken"], F.get(at, i)["pseudonym"]).otherwise(F.lit("")),
        F.substring(x, F.get(new, i)["skip"] + 1, F.length(x)))), "")
    none = F.array().cast("array<struct<kind:string,pseudonym:string>>")
    return (work.withColumns({
        text: F.when(F.size(valid) > 0, joined).otherwise(t),
        found: F.coalesce(F.transform(valid, lambda x: F.struct(
            x["kind"].alias("kind"), x["pseudonym"].alias("pseudonym"))), none)})
        .drop("_pii_windows", "_pii_pieces", "_pii_at", "_pii_new"))
