"""Format-preserving pseudonyms for personal data in texts, in DataFrame functions only.

One pattern finds candidates in a text. A candidate that passes the checks of its kind (check digits, ranges, calendar) is
replaced by the output of a keyed Feistel network over the values of the same format; all else stays as it is. A network is a
permutation, so different values get different pseudonyms, and equal values, however they are punctuated, get equal digits in
all documents. Nothing is shuffled: every row is rewritten by itself.

Kinds: card (13 to 19 digits, Luhn; the pseudonym passes Luhn too), iban (mod 97; likewise), ssn, phone, ip, date (a day between
1900 and 2099 stays one), email (letters and digits of the local part), secret (hex strings of 32 and more). Candidates that
fail their check stay. Cards and IBANs of the usual groups are found first, also where digits or words that follow would fit a longer candidate.

A null text stays null with 0 found, an empty one empty; texts of any length are scanned whole; repeated rows give equal results;
an empty table gives an empty one; other columns, whatever their names, stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

#: Fixed patterns, in order of precedence: an earlier kind wins where two match at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2(?:19|20)[0-9]{2})(?![0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
             r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Countries by the length of their IBANs, and the usual groups of card numbers.
IBAN_COUNTRIES = {15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
                  23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
                  28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
BOUNDED = "|".join([r"[0-9]{13,19}", r"[0-9]{4}([ -])[0-9]{4}(?:\2[0-9]{4}){2}", r"[0-9]{4}([ -])[0-9]{6}\3[0-9]{5}",
                    *[rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{{n // 4 - 1}}}" + (rf" ?[0-9A-Z]{{{n % 4}}}" if n % 4 else "")
                      for n, c in IBAN_COUNTRIES.items()]])
#: What may not stand before and after them: parts of other words, addresses and numbers.
BEFORE, AFTER = r"(?<![0-9A-Za-z._%+@])(?<!\+[0-9]{1,3}[ .-])", r"(?![0-9A-Za-z@]|[._%+-][A-Za-z0-9._%+-]*@)"
#: A text without these has no candidate.
HINT = "[0-9@]"
#: Days of the months, February of a leap year; days from 1900-01-01 to 2099-12-31 are LEFT_DAYS * RIGHT_DAYS.
MONTH_DAYS = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
LEFT_DAYS, RIGHT_DAYS = 17, 4297


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permuted(values: Column, radices: Column, key: str, tweak: Column) -> Column:
    """Feistel network over vectors: entry j is below ``radices[j]``. The halves take turns in being shifted, entry by entry,
    by a digest of the other half."""
    half = (F.size(values) / 2).cast("int")

    def shift(part: Column, other: Column, place: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), tweak, turn.cast("string"), F.array_join(other.cast("array<string>"), ",")), 512)
        return let(digest, lambda d: F.transform(part, lambda x, j: (
            x + F.conv(F.substring(d, (j % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")) % F.get(radices, place + j)))

    def round_(v: Column, turn: Column) -> Column:
        left, right = F.slice(v, F.lit(1), half), F.slice(v, half + 1, F.size(v) - half)
        return F.when(turn % 2 == 0, F.concat(shift(left, right, F.lit(0), turn), right)) \
            .otherwise(F.concat(left, shift(right, left, half, turn)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, round_)


def characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)))


def luhn_sum(digits: Column, doubled_from: int) -> Column:
    """Sum of a Luhn check from the right; every second digit is doubled, beginning with the first (0) or second (1)."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == doubled_from, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def mod97(alnum: Column) -> Column:
    """Remainder by 97 of an upper-case alphanumeric string, letters A to Z read as 10 to 35."""
    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(characters(alnum), F.lit(0), add)


def date_parts(m: Column) -> Column:
    """Year, month, day and whether the year, or the month, stands first. Slashes read as month/day/year where that is a date."""
    n = lambda start, size: F.substring(m, start, size).cast("int")
    year_first = m.rlike("^[0-9]{4}")
    month_first = ~year_first & m.contains("/") & n(1, 2).between(1, 12)
    return F.struct(F.when(year_first, n(1, 4)).otherwise(n(7, 4)).alias("y"),
                    F.when(year_first, n(6, 2)).when(month_first, n(1, 2)).otherwise(n(4, 2)).alias("m"),
                    F.when(year_first, n(9, 2)).when(month_first, n(4, 2)).otherwise(n(1, 2)).alias("d"),
                    year_first.alias("year_first"), month_first.alias("month_first"))


def is_date(m: Column) -> Column:
    def check(p: Column) -> Column:
        leap = (p["y"] % 4 == 0) & ((p["y"] % 100 != 0) | (p["y"] % 400 == 0))
        most = F.get(F.array(*[F.lit(d) for d in MONTH_DAYS]), p["m"] - 1) - F.when((p["m"] == 2) & ~leap, 1).otherwise(0)
        return p["m"].between(1, 12) & p["d"].between(1, most)

    return let(date_parts(m), check)


def kind_of(m: Column) -> Column:
    """Kind of a candidate that passes its check, else null."""
    whole = lambda k: m.rlike(f"^(?:{PATTERNS[k]})$")
    digits, alnum = F.regexp_replace(m, "[^0-9]", ""), F.regexp_replace(m, " ", "")
    part = lambda i: F.split_part(m, F.lit("-"), F.lit(i)).cast("int")
    octets = F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)
    return (F.when(whole("email"), "email").when(whole("secret"), "secret")
            .when(whole("iban") & (mod97(F.concat(F.substring(alnum, 5, 64), F.substring(alnum, 1, 4))) == 1), "iban")
            .when(whole("date") & is_date(m), "date").when(whole("ip") & octets, "ip")
            .when(whole("ssn") & ~part(1).isin(0, 666) & (part(1) < 900) & (part(2) > 0) & (part(3) > 0), "ssn")
            .when(whole("card") & (luhn_sum(digits, 1) % 10 == 0), "card").when(whole("phone"), "phone"))


def _alphabet(kind: Column, m: Column, c: Column, is_first: Column) -> Column:
    """The characters that may stand in for ``c``, in order."""
    return (F.when(kind == "secret", F.when(m.rlike("[A-F]"), F.lit("0123456789ABCDEF")).otherwise(F.lit("0123456789abcdef")))
            .when((kind == "phone") & is_first, F.when(c == "0", F.lit("0")).otherwise(F.lit("123456789")))
            .when(c.between("0", "9"), F.lit("0123456789")).when(c.between("a", "z"), F.lit("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")))


def _by_character(m: Column, kind: Column, key: str) -> Column:
    """Pseudonym of the kinds that are strings of digits and letters."""
    lead = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])|^\+1", 0)
    body = (F.when(kind == "email", F.substring_index(m, "@", 1)).when(kind == "iban", F.substring(m, F.lit(5), F.length(m)))
            .when(kind == "phone", F.substring(m, F.length(lead) + 1, F.length(m)))
            .when(kind == "card", F.substring(m, F.lit(1), F.length(m) - 1)).otherwise(m))

    def render(b: Column) -> Column:
        symbols = F.filter(characters(b), lambda c: c.rlike("[0-9A-Za-z]"))
        alphabets = F.transform(symbols, lambda c, i: _alphabet(kind, m, c, i == 0))
        values = F.transform(symbols, lambda c, i: F.instr(F.get(alphabets, i), c) - 1)
        radices = F.transform(alphabets, F.length)

        def put(new: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                nth = F.length(F.regexp_replace(F.substring(b, F.lit(1), i + 1), "[^0-9A-Za-z]", "")) - 1
                return F.when(c.rlike("[0-9A-Za-z]"), F.substring(_alphabet(kind, m, c, nth == 0), F.get(new, nth) + 1, F.lit(1))).otherwise(c)
            return F.array_join(F.transform(characters(b), one), "")

        return let(permuted(values, radices, key, kind), put)

    def finish(out: Column) -> Column:
        check = ((10 - luhn_sum(F.regexp_replace(out, "[^0-9]", ""), 0) % 10) % 10).cast("string")
        country = F.substring(m, 1, 2)
        control = F.lpad((98 - mod97(F.concat(F.regexp_replace(out, " ", ""), country, F.lit("00")))).cast("string"), 2, "0")
        return (F.when(kind == "email", F.concat(out, F.lit("@"), F.substring_index(m, "@", -1))).when(kind == "iban", F.concat(country, control, out))
                .when(kind == "phone", F.concat(lead, out)).when(kind == "card", F.concat(out, check)).otherwise(out))

    return let(let(body, render), finish)


def _by_number(m: Column, kind: Column, key: str) -> Column:
    """Pseudonym of the kinds that are numbers with ranges: ip, ssn, date."""
    pad = lambda n, size: F.lpad(n.cast("string"), size, "0")
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    ip = F.array_join(permuted(octets, F.transform(octets, lambda _: F.lit(256)), key, kind).cast("array<string>"), ".")
    part = lambda i: F.split_part(m, F.lit("-"), F.lit(i)).cast("int")
    ssn = let(permuted(F.array(part(1) - F.when(part(1) > 666, 2).otherwise(1), part(2) - 1, part(3) - 1),
                       F.array(F.lit(898), F.lit(99), F.lit(9999)), key, kind),
              lambda v: F.concat_ws("-", pad(F.get(v, F.lit(0)) + F.when(F.get(v, F.lit(0)) > 664, 2).otherwise(1), 3),
                                    pad(F.get(v, F.lit(1)) + 1, 2), pad(F.get(v, F.lit(2)) + 1, 4)))

    def dated(p: Column) -> Column:
        index = F.datediff(F.make_date(p["y"], p["m"], p["d"]), F.lit("1900-01-01").cast("date"))
        new = let(permuted(F.array((index / RIGHT_DAYS).cast("int"), index % RIGHT_DAYS), F.array(F.lit(LEFT_DAYS), F.lit(RIGHT_DAYS)), key, kind),
                  lambda v: F.date_add(F.lit("1900-01-01").cast("date"), F.get(v, F.lit(0)) * RIGHT_DAYS + F.get(v, F.lit(1))))
        sep = F.when(p["year_first"], F.substring(m, 5, 1)).otherwise(F.substring(m, 3, 1))
        y, mo, d = (lambda t: pad(F.year(t), 4)), (lambda t: pad(F.month(t), 2)), (lambda t: pad(F.day(t), 2))
        return let(new, lambda t: F.when(p["year_first"], F.concat(y(t), sep, mo(t), sep, d(t)))
                   .when(p["month_first"], F.concat(mo(t), sep, d(t), sep, y(t))).otherwise(F.concat(d(t), sep, mo(t), sep, y(t))))

    return F.when(kind == "ip", ip).when(kind == "ssn", ssn).otherwise(let(date_parts(m), dated))


def pseudonym(m: Column, key: str) -> Column:
    """A candidate's pseudonym, or the candidate itself if it fails its check."""
    return let(kind_of(m), lambda k: F.when(k.isNull(), m).when(k.isin("ip", "ssn", "date"), _by_number(m, k, key)).otherwise(_by_character(m, k, key)))


def segments(body: Column) -> Column:
    """The text in pieces: cards and IBANs of the usual forms that pass their check stand alone, whatever digits or words surround them."""
    alnum = lambda m: F.regexp_replace(m, "[ -]", "")
    valid = lambda m: F.when(m.rlike("^[0-9]"), luhn_sum(alnum(m), 1) % 10 == 0).otherwise(
        mod97(F.concat(F.substring(alnum(m), 5, 64), F.substring(alnum(m), 1, 4))) == 1)
    listed = F.filter(F.array_distinct(F.regexp_extract_all(body, F.lit(f"{BEFORE}(?=({BOUNDED}){AFTER})"), F.lit(1))), valid)

    def cut(found: Column) -> Column:
        one = F.concat(F.lit("(?:"), F.array_join(found, "|"), F.lit(")"))
        pattern = F.concat(F.lit(BEFORE + "(?="), one, F.lit(AFTER + ")|(?<=" + BEFORE), one, F.lit(")" + AFTER))
        return F.when(F.size(found) > 0, F.split(body, pattern, -1)).otherwise(F.array(body))

    return let(listed, cut)


def pseudonymised(docs: DataFrame, key: str, text: str = "text", kinds: str = "pii_kinds") -> DataFrame:
    """``docs`` with ``text`` rewritten; the kinds that were replaced, in order, are in a last column ``kinds`` (an array).

    A column of that name in ``docs`` stays, and the new one gets underscores until its name is free.
    """
    while kinds in docs.columns:
        kinds += "_"
    body = F.col("row")[text]
    marked = docs.select(F.struct("*").alias("row")).withColumn("parts", F.when(body.rlike(HINT), segments(body)))
    marked = marked.withColumn("found", F.transform("parts", lambda p: F.regexp_extract_all(p, F.lit(PATTERN), F.lit(0))))

    def weave(part: Column, found: Column) -> Column:
        pieces = F.split(part, PATTERN, -1)
        woven = F.flatten(F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda gap, m: F.array(gap, pseudonym(m, key))))
        return F.when(F.size(found) > 0, F.array_join(F.concat(woven, F.slice(pieces, -1, 1)), "")).otherwise(part)

    new = F.when(F.size(F.flatten("found")) > 0, F.array_join(F.zip_with("parts", "found", weave), "")).otherwise(body)
    replaced = F.coalesce(F.filter(F.transform(F.flatten("found"), kind_of), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return marked.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns], replaced.alias(kinds))
