r"""Format-preserving pseudonyms by keyed Feistel networks.

Mail addresses, access keys, hexadecimal secrets, IP addresses, phone numbers, social-security numbers, dates, bank
account numbers and card numbers are found by one pattern, validated (octets, Luhn and mod-97 checks, calendar) and
replaced by another valid value of the same format. Equal values get equal pseudonyms under one key, in all documents,
and the key holder can take them back.

A value with a numeric domain is a pair (l, r) below (a, b): rounds add a keyed hash of one half to the other, modulo its size. Text is
halved too, and each character moves within its own alphabet. Both are permutations of their domain. The hash is
SHA-2 of key, kind, round and half. Everything is column expressions; only texts that hold a digit, an at sign or a key prefix are searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DIGITS, HEX = "0123456789", "0123456789abcdef"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PLAIN = (LOWER, UPPER, DIGITS)

# Fixed patterns, in the order they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    # Other international numbers: a country code, then digits in one run or in groups with one kind of separator.
    "intl": r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:(?<sep>[ .-])(?:\([0-9]{1,4}\)|[0-9]{1,8})(?:\k<sep>[0-9]{1,8}){0,5}|[0-9]{7,12})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])",
    # One run of digits, or groups of the usual sizes. A last group of one to three digits needs the separator of the others, and nothing that goes on behind it.
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?<gap>[ -])(?:[0-9]{4}\k<gap>){3}[0-9]{1,3}(?![.,/:-]?[0-9])|"
    + "|".join(g.replace(" ", "[ -]").replace("d", "[0-9]") for g in ("d{4} d{4} d{4} d{1,7}", "d{4} d{6} d{4,5}", "d{6} d{13}"))
    + r")(?![0-9A-Za-z])",
}
#: Digits of a phone number with its country code.
E164 = (8, 15)
_ANY = "|".join(PATTERNS.values())
_MAY_HOLD = "[0-9@]|AKIA|ASIA"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digest(key: str, kind: str, rnd: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), rnd.cast("string"), half.cast("string")), 512)


def _number(digest: Column) -> Column:
    return F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def _rounds(back: bool) -> Column:
    return F.lit([*range(ROUNDS)][:: -1 if back else 1])


def permute_pair(l: Column, r: Column, a: Column | int, b: Column | int, key: str, kind: str, back: bool = False) -> Column:
    """Struct (l, r) permuted within l < a, r < b."""
    a, b = (x if isinstance(x, Column) else F.lit(x) for x in (a, b))
    a, b, sign = a.cast("bigint"), b.cast("bigint"), -1 if back else 1

    def step(s: Column, rnd: Column) -> Column:
        even = rnd % 2 == 0
        move = sign * _number(_digest(key, kind, rnd, F.when(even, s["r"]).otherwise(s["l"])))
        return F.struct(F.when(even, F.pmod(s["l"] + move % a, a)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(F.pmod(s["r"] + move % b, b)).alias("r"))

    return F.aggregate(_rounds(back), F.struct(l.cast("bigint").alias("l"), r.cast("bigint").alias("r")), step)


def permute_text(text: Column, key: str, kind: str, alphabets: tuple[str, ...] = PLAIN, back: bool = False) -> Column:
    """Each character moved within its alphabet; characters of none stay."""
    sign = -1 if back else 1

    def moved(half: Column, digest: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            k = sign * F.conv(F.substr(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            out = c
            for alphabet in alphabets:
                at = F.instr(F.lit(alphabet), c)
                out = F.when(at > 0, F.substr(F.lit(alphabet), F.pmod(at - 1 + k, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
            return out

        return F.when(half == "", half).otherwise(F.array_join(F.transform(F.split(half, ""), one), ""))

    def step(s: Column, rnd: Column) -> Column:
        even = rnd % 2 == 0
        still, turned = F.when(even, s["r"]).otherwise(s["l"]), F.when(even, s["l"]).otherwise(s["r"])
        return _let(
            F.struct(still.alias("still"), moved(turned, _digest(key, kind, rnd, still)).alias("new")),
            lambda x: F.struct(F.when(even, x["new"]).otherwise(x["still"]).alias("l"), F.when(even, x["still"]).otherwise(x["new"]).alias("r")),
        )

    cut = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), cut).alias("l"), F.substr(text, cut + 1).alias("r"))
    return F.aggregate(_rounds(back), start, step, lambda s: F.concat(s["l"], s["r"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """The digits of ``shape`` replaced in order."""
    step = lambda s, c: F.when(F.instr(F.lit(DIGITS), c) > 0, F.struct(F.concat(s["t"], F.substr(digits, s["i"], F.lit(1))).alias("t"), (s["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(s["t"], c).alias("t"), s["i"].alias("i"))
    )
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), step, lambda s: s["t"])


def _part(text: Column, at: int, n: int) -> Column:
    return F.substr(text, F.lit(at), F.lit(n)).cast("bigint")


def _padded(number: Column, n: Column | int) -> Column:
    return F.lpad(number.cast("string"), n, F.lit("0"))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum; a valid number's ends in 0."""

    def step(total: Column, x: Column) -> Column:
        d = x["c"].cast("int") * F.when(x["odd"], 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    marked = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.alias("c"), (i % 2 == 1).alias("odd")))
    return F.aggregate(marked, F.lit(0), step)


def _card(m: Column, key: str, back: bool) -> Column:
    """A valid number, whole. If four groups of four are one without the group of one to three digits behind them, that group stays; numbers of this kind
    are permuted among themselves: a step that makes the whole valid is followed by another."""

    def moved(d: Column) -> Column:
        n = F.length(d) - 1
        right = F.floor(n / 2).cast("int")
        body = F.substr(d, F.lit(1), n)
        left = n - right
        pair = permute_pair(F.substr(body, F.lit(1), left).cast("bigint"), F.substr(body, left + 1).cast("bigint"), F.pow(F.lit(10), left), F.pow(F.lit(10), right), key, "card", back)
        made = _let(pair, lambda p: F.concat(_padded(p["l"], left), _padded(p["r"], right)))
        return _let(made, lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))

    good = lambda d: luhn_sum(d) % 10 == 0

    def valid(d: Column) -> Column:
        head, tail = F.substr(d, F.lit(1), F.lit(16)), F.substr(d, F.lit(17))
        apart = F.rlike(m, F.lit("^(?:[0-9]{4}[ -]){4}[0-9]{1,3}$"))
        walk = lambda s, _: F.when(s["done"], s).otherwise(_let(moved(s["d"]), lambda x: F.struct(x.alias("d"), (~good(F.concat(x, tail))).alias("done"))))
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(head.alias("d"), F.lit(False).alias("done")), walk, lambda s: F.concat(s["d"], tail))
        return F.when(good(d), _refill(m, moved(d))).when(apart & good(head), _refill(m, walked)).otherwise(m)

    return _let(_digits(m), valid)


def _intl(m: Column, key: str, back: bool) -> Column:
    """The digits behind the country code, which ends at the first separator; of a run of digits the first two stay."""

    def made(d: Column) -> Column:
        code = F.regexp_extract(m, r"^\+([0-9]{1,3})[ .-]", 1)
        kept = F.when(F.length(code) > 0, F.length(code)).otherwise(2)
        new = F.concat(F.substr(d, F.lit(1), kept), permute_text(F.substr(d, kept + 1), key, "intl", (DIGITS,), back))
        return F.when(F.length(d).between(*E164), _refill(m, new)).otherwise(m)

    return _let(_digits(m), made)


def _ip(m: Column, key: str, back: bool) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))

    def made(o: Column) -> Column:
        pair = permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip", back)
        new = _let(pair, lambda p: F.concat_ws(".", *(x.cast("bigint").cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))))
        return F.when(F.forall(o, lambda x: x <= 255), new).otherwise(m)

    return _let(octets, made)


def _phone(m: Column, key: str, back: bool) -> Column:
    """The last ten digits; a country code stays. Area and exchange keep a first digit from 2 on where both have one."""

    def made(d: Column) -> Column:
        head, own = F.substr(d, F.lit(1), F.length(d) - 10), F.substr(d, F.length(d) - 9)
        area, rest = _part(own, 1, 3), _part(own, 4, 7)
        usual = (area >= 200) & (rest >= 2_000_000)
        low, size = F.when(usual, 200).otherwise(0), F.when(usual, 800).otherwise(1000)
        # An unusual number must not turn into a usual one: both sets are permuted within themselves.
        pair = permute_pair(area - low, rest - low * 10_000, size, size * 10_000, key, "phone", back)
        new = _let(pair, lambda p: F.concat(head, _padded(p["l"] + low, 3), _padded(p["r"] + low * 10_000, 7)))
        odd = _let(_rank_odd(area, rest), lambda k: _unrank_odd(permute_pair(F.floor(k / 3600), k % 3600, 1_000_000, 3600, key, "phone odd", back)))
        return _refill(m, F.when(usual, new).otherwise(F.concat(head, odd)))

    return _let(_digits(m), made)


def _rank_odd(area: Column, rest: Column) -> Column:
    """Place of a number with area or exchange below 200 among all of these: 200 areas of 10**7, then 800 areas of 2 * 10**6."""
    return F.when(area < 200, area * 10_000_000 + rest).otherwise(F.lit(2_000_000_000).cast("bigint") + (area - 200) * 2_000_000 + rest)


def _unrank_odd(pair: Column) -> Column:
    def digits(k: Column) -> Column:
        j = k - 2_000_000_000
        low = F.concat(_padded(F.floor(k / 10_000_000).cast("bigint"), 3), _padded(k % 10_000_000, 7))
        high = F.concat(_padded(F.floor(j / 2_000_000).cast("bigint") + 200, 3), _padded(j % 2_000_000, 7))
        return F.when(k < 2_000_000_000, low).otherwise(high)

    return _let(_let(pair, lambda p: p["l"] * 3600 + p["r"]), digits)


def _ssn(m: Column, key: str, back: bool) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = _part(m, 1, 3), _part(m, 5, 2), _part(m, 8, 4)
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permute_pair(rank, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", back)

    def made(p: Column) -> Column:
        a = p["l"] + 1 + F.when(p["l"] + 1 >= 666, 1).otherwise(0)
        return F.concat_ws("-", _padded(a, 3), _padded(F.floor(p["r"] / 9999).cast("bigint") + 1, 2), _padded(p["r"] % 9999 + 1, 4))

    good = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(good, _let(pair, made)).otherwise(m)


def _date(m: Column, key: str, back: bool) -> Column:
    """Years 1900 to 2099; a leap year stays one, so day 366 always exists. Slashes are read as month/day/year, else as day/month/year."""
    iso, us, eu = (F.try_to_timestamp(m, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy"))
    dashed = F.contains(m, F.lit("-"))
    day = F.when(dashed, iso).otherwise(F.coalesce(us, eu))

    def made(d: Column) -> Column:
        year, doy = F.year(d), F.dayofyear(d) - 1
        leap = (year % 4 == 0) & (year != 1900)
        before = F.floor((year - 1900) / 4).cast("int")  # leap years from 1904 up to this year
        rank = F.when(leap, before - 1).otherwise(year - 1900 - before)
        days, count = F.when(leap, 366).otherwise(365), F.when(leap, 49).otherwise(151)
        pair = permute_pair(rank, doy, count, days, key, "date", back)

        def put(p: Column) -> Column:
            # Years that are not leap: 1900 to 1903, then three of every four.
            y = F.when(leap, 1904 + 4 * p["l"]).otherwise(F.when(p["l"] < 4, 1900 + p["l"]).otherwise(1905 + F.floor((p["l"] - 4) / 3) * 4 + (p["l"] - 4) % 3)).cast("int")
            new = F.date_add(F.make_date(y, F.lit(1), F.lit(1)), p["r"].cast("int"))
            return F.when(dashed, F.date_format(new, "yyyy-MM-dd")).when(us.isNotNull(), F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy"))

        return F.when(year.between(1900, 2099), _let(pair, put)).otherwise(m)

    return F.coalesce(_let(day, made), m)


def _mod97(text: Column) -> Column:
    values = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1)
    return F.aggregate(values, F.lit(0), lambda s, v: (s * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban(m: Column, key: str, back: bool) -> Column:
    """The account part moves, country and layout stay, the check digits follow."""

    def made(x: Column) -> Column:
        country, account = F.substr(x, F.lit(1), F.lit(2)), F.substr(x, F.lit(5))
        new = permute_text(account, key, "iban", (DIGITS, UPPER), back)
        full = _let(new, lambda n: F.concat(country, _padded(98 - _mod97(F.concat(n, country, F.lit("00"))), 2), n))
        spaced = _let(full, lambda f: F.aggregate(
            F.split(m, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")),
            lambda s, c: F.when(c == " ", F.struct(F.concat(s["t"], c).alias("t"), s["i"].alias("i"))).otherwise(F.struct(F.concat(s["t"], F.substr(f, s["i"], F.lit(1))).alias("t"), (s["i"] + 1).alias("i"))),
            lambda s: s["t"],
        ))
        return F.when(_mod97(F.concat(account, F.substr(x, F.lit(1), F.lit(4)))) == 1, spaced).otherwise(m)

    return _let(F.replace(m, F.lit(" "), F.lit("")), made)


def _email(m: Column, key: str, back: bool) -> Column:
    """The name, and the domain without its last label, each on its own: equal domains stay linked too."""
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    top = F.substring_index(domain, ".", -1)
    own = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    return F.concat(permute_text(name, key, "mail name", PLAIN, back), F.lit("@"), permute_text(own, key, "mail domain", PLAIN, back), top)


def _secret(m: Column, key: str, back: bool) -> Column:
    lower = F.rlike(m, F.lit("^[0-9a-f]+$"))
    return F.when(lower, permute_text(m, key, "secret", (HEX,), back)).otherwise(permute_text(m, key, "secret", (HEX.upper(),), back))


def _access_key(m: Column, key: str, back: bool) -> Column:
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), permute_text(F.substr(m, F.lit(5)), key, "access key", (UPPER + DIGITS,), back))


_MAKERS = {"email": _email, "access_key": _access_key, "secret": _secret, "iban": _iban, "ip": _ip, "phone": _phone, "intl": _intl, "ssn": _ssn, "date": _date, "card": _card}


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """Struct (kind, text) of one found value; text is the value itself where it is not valid."""
    kind = F.lit(None).cast("string")
    text = value
    for k in reversed(PATTERNS):
        own = F.rlike(value, F.lit(f"^(?:{PATTERNS[k]})$"))
        kind, text = F.when(own, F.lit(k)).otherwise(kind), F.when(own, _MAKERS[k](value, key, back)).otherwise(text)
    return F.struct(kind.alias("kind"), text.alias("text"))


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the text replaced, plus pii_kinds: the kind of each replaced value, in order.

    With ``back`` and the same key the values return. A null text stays null and an empty one empty, with no kinds;
    numbers that fail their check stay as they are. All other columns pass unchanged, an own pii_kinds column
    is replaced; repeated rows are treated alike; an empty table stays empty.
    """
    text = F.col(text_col).cast("string")

    def replaced(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(_ANY), F.lit(0))
        between = F.split(t, _ANY, -1)
        return _let(
            F.transform(found, lambda m: F.struct(m.alias("old"), pseudonym(m, key, back).alias("new"))),
            lambda ms: F.struct(
                F.array_join(F.zip_with(between, ms, lambda s, m: F.concat(s, F.coalesce(m["new"]["text"], F.lit("")))), "").alias("text"),
                F.transform(F.filter(ms, lambda m: m["old"] != m["new"]["text"]), lambda m: m["new"]["kind"]).alias("kinds"),
            ),
        )

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    out = F.when(F.rlike(text, F.lit(_MAY_HOLD)), _let(text, replaced)).otherwise(none)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "pii_kinds")]
    result = docs.select(*others, out.alias("__out")).select(*others, F.col("__out.text").alias(text_col), F.col("__out.kinds").alias("pii_kinds"))
    return result.select(*(F.col(f"`{c}`") for c in docs.columns if c != "pii_kinds"), "pii_kinds")
