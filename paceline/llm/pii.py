"""Format-preserving pseudonyms for personal data and secrets.

Found and checked values are replaced by a keyed permutation of all values of the same format: cards
(13 to 19 digits with a right check digit, which the pseudonym has too), IBANs (with right check digits, likewise), telephone and social
security numbers, dates of the calendar (day, month or year first, with - / or ., of one or two digits, also before T and a time; or with
an English month), IPv4 addresses, e-mail addresses, access keys, and
values of passwords and tokens. A value that fails its check (a wrong check digit, a day that does not
exist, an octet above 255) stays as it is. Equal values get equal pseudonyms in every document, different
ones different pseudonyms.

What is permuted is the value, not the way it is written: a card's, an IBAN's or a telephone number's bare characters and a
date's day number move, and the result is written in the layout that was found. So `4111 1111 1111 1111` and `4111111111111111`
are one card, `2024-01-02`, `02.01.2024` and `2 January 2024` one day, `+1 (212) 555-0123` and `212-555-0123` one number. Dates with a
one-digit day or month keep the shape they have and are linked only within it.

The permutation is a Feistel network. Texts are halved and each character is moved within its own kind
(digits, lower case, upper case; letters a to f in hexadecimal tokens), other characters stay in
place. Dates are numbered within four hundred years, 146,097 = 189 x 773 days (with a one-digit day or month: within
those of the same shape), addresses within 65,536 x 65,536,
and the two residues are moved in turn, so no value leaves its format. The round function is a keyed SHA-256.

A text is cut at the matches of one pattern and put together again from the pieces between and the
pseudonyms, in its row: nothing is shuffled, whatever is frequent.

Defined cases: null text stays null, empty text empty; repeated rows get equal results; other columns
pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import fresh

ROUNDS = 6
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
# What is looked for.
KINDS = {
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|secret(?:[_-](?:access[_-])?key)?|token|api[_-]?key)[\"']?\s*[=:]\s*[\"']?(?:[^\s\"'<>(),;&]|&(?!\w+=)){5,}[A-Za-z0-9+/_-]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\d._%+-])[\p{L}\d][\p{L}\d._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
    "phone": r"(?<!\w)\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)|(?<![\w+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}-\d{1,2}-\d{4})(?:(?=T\d\d)|(?![\w-]))|(?<![\w/])(?:\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4})(?:(?=T\d\d)|(?![\w/]))"
            r"|(?<![\w.])(?:\d{4}\.\d{1,2}\.\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?=T\d\d)|(?!\w|\.\d))"
            rf"|(?<!\w)(?:\d{{1,2}} (?:{MONTHS}) \d{{4}}|(?:{MONTHS}) \d{{1,2}}, \d{{4}})(?!\w)",
    "card": r"(?<!\w)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w)",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
}
PATTERN = "|".join(KINDS.values())
# Any match has one of these.
NEEDED = "[0-9@=:]|AKIA|ASIA"
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
YEARS_FROM, DAYS = "1800-01-01", (189, 773)


def _noise(key: str, kind: str | Column, round: Column, half: Column) -> Column:
    lead = F.lit(f"{key}|{kind}|") if isinstance(kind, str) else F.concat(F.lit(f"{key}|"), kind, F.lit("|"))
    return F.sha2(F.concat(lead, round.cast("string"), F.lit("|"), half), 256)


def _moved(text: Column, noise: Column, letters: int) -> Column:
    """Each character moved within its kind, by twelve bits of the noise; of the lower-case letters only
    the first ``letters`` are a kind."""

    def step(i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        by = F.conv(F.substring(noise, (i * 2 - 2) % 61 + 1, F.lit(3)), 16, 10).cast("int")
        out = c
        for alphabet in (ALPHABETS[0][:letters], *ALPHABETS[1:]):
            new = F.substring(F.lit(alphabet), F.pmod(F.instr(F.lit(alphabet), c) - 1 + by, F.lit(len(alphabet))) + 1, F.lit(1))
            out = F.when(F.instr(F.lit(alphabet), c) > 0, new).otherwise(out)
        return out

    moved = F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), step), "")
    return F.when(F.length(text) > 0, moved).otherwise(text)


def permuted_text(text: Column, key: str, kind: str, letters: int = 26) -> Column:
    """The pseudonym of a text: same length, same kind of character at each place."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.length(text)).alias("r")
    )

    def round(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        left = F.struct(_moved(l, _noise(key, kind, i, r), letters).alias("l"), r.alias("r"))
        right = F.struct(l.alias("l"), _moved(r, _noise(key, kind, i, l), letters).alias("r"))
        return F.when(i % 2 == 1, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round, lambda s: F.concat(s["l"], s["r"]))


def permuted_number(number: Column, key: str, kind: str | Column, rows: int | Column, columns: int | Column) -> Column:
    """The pseudonym of a number below ``rows * columns``, of the same range."""
    start = F.struct(F.floor(number / columns).cast("long").alias("l"), (number % columns).cast("long").alias("r"))

    def round(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        by = lambda half: F.conv(F.substring(_noise(key, kind, i, half.cast("string")), 1, 12), 16, 10).cast("long")
        left = F.struct(((l + by(r)) % rows).alias("l"), r.alias("r"))
        right = F.struct(l.alias("l"), ((r + by(l)) % columns).alias("r"))
        return F.when(i % 2 == 1, left).otherwise(right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round, lambda s: s["l"] * columns + s["r"])


def luhn_sum(digits: Column) -> Column:
    """The sum of a digit string's check, from its last digit."""

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def in_layout(value: Column, bare: Column, kept: str = "0-9") -> Column:
    """``value`` with its characters of the kind ``kept`` replaced, in order, by those of ``bare``."""
    gaps, new = F.split(value, f"[{kept}]", -1), F.split(bare, "")
    return F.array_join(F.zip_with(gaps, new, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit("")))), "")


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")

    def checked(pseudonym: Column) -> Column:
        rest = luhn_sum(F.concat(pseudonym, F.lit("0")))
        return in_layout(value, F.concat(pseudonym, ((10 - rest % 10) % 10).cast("string")))

    return F.when(luhn_sum(digits) % 10 == 0, _once(body, checked))


def iban_rest(bare: Column) -> Column:
    """The remainder by 97 of a bare IBAN, its first four characters last and letters as 10 to 35."""
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, rest * 100 + letter).otherwise(rest * 10 + F.ascii(c) - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    bare = F.regexp_replace(value, " ", "")
    account = permuted_text(F.substring(bare, F.lit(5), F.length(bare)), key, "iban")
    country = F.substring(bare, F.lit(1), F.lit(2))

    def checked(pseudonym: Column) -> Column:
        check = 98 - iban_rest(F.concat(country, F.lit("00"), pseudonym))
        return in_layout(value, F.concat(country, F.lpad(check.cast("string"), 2, "0"), pseudonym), "A-Z0-9")

    return F.when(F.length(bare).between(15, 34) & (iban_rest(bare) == 1), _once(account, checked))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, "\\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o)

    def dotted(n: Column) -> Column:
        return F.concat_ws(".", *[(F.floor(n / 256**i).cast("long") % 256).cast("string") for i in (3, 2, 1, 0)])

    new = F.element_at(F.transform(F.array(permuted_number(number, key, "ip", 65536, 65536)), dotted), 1)
    return F.when(F.array_max(octets) < 256, new)


# Months and days as they are written with one digit for one of them at least, for each shape those of any year.
_LONG = {m: 31 if m in (1, 3, 5, 7, 8, 10, 12) else 28 if m == 2 else 30 for m in range(1, 13)}
SHORT = {
    "Md": [f"{m}|{d}" for m in range(1, 10) for d in range(1, 10)],
    "Mdd": [f"{m}|{d:02}" for m in range(1, 10) for d in range(1, 29)],
    "Mdd-end": [f"{m}|{d}" for m in range(1, 10) for d in range(29, _LONG[m] + 1)],
    "MMd": [f"{m:02}|{d}" for m in range(1, 13) for d in range(1, 10)],
}
LEAP = [str(y) for y in range(1800, 2200) if y % 4 == 0 and (y % 100 or y % 400 == 0)]


ORDERS = ("yMd", "dMy", "Mdy")


def _date(value: Column, key: str) -> Column:
    """A date's number within its layout is permuted; of day and month first, what the calendar allows is taken, the day before the month."""
    mark, parts = F.regexp_extract(value, "[-/.]", 0), F.split(value, "[-/.]")
    none = F.lit(None).cast("struct<kind:string,number:bigint,rows:int,columns:int>")
    whole, short = [], []

    def found(fits: Column, kind: Column, number: Column, rows: int, columns: int) -> Column:
        return F.when(fits, F.struct(kind.alias("kind"), number.cast("long").alias("number"), F.lit(rows).alias("rows"), F.lit(columns).alias("columns"))).otherwise(none)

    for order in ORDERS:
        wide = {"y": "yyyy", "M": "MM", "d": "dd"}
        layout = F.concat(F.lit(wide[order[0]]), mark, F.lit(wide[order[1]]), mark, F.lit(wide[order[2]]))
        number = F.datediff(F.to_date(F.try_to_timestamp(value, layout)), F.lit(YEARS_FROM).cast("date"))
        whole.append(found((F.length(value) == 10) & (number >= 0) & (number < DAYS[0] * DAYS[1]), layout, number, *DAYS))
        year, month, day = (parts[order.index(x)] for x in "yMd")
        right = (F.length(value) < 10) & (F.length(year) == 4) & year.between("1800", "2199")
        for shape, slots in SHORT.items():
            place = F.array_position(F.array(*map(F.lit, slots)), F.concat(month, F.lit("|"), day))
            short.append(found(right & (place > 0), F.lit(f"{order}|{shape}"), (year.cast("long") - 1800) * len(slots) + place - 1, 400, len(slots)))
        leap = F.array_position(F.array(*map(F.lit, LEAP)), year)
        short.append(found(right & (month == "2") & (day == "29") & (leap > 0), F.lit(f"{order}|leap"), leap - 1, 1, len(LEAP)))

    for layout in ("d MMMM yyyy", "MMMM d, yyyy"):
        number = F.datediff(F.to_date(F.try_to_timestamp(value, F.lit(layout))), F.lit(YEARS_FROM).cast("date"))
        whole.append(found(value.rlike("[a-z]") & (number >= 0) & (number < DAYS[0] * DAYS[1]), F.lit(layout), number, *DAYS))

    def moved(at: Column) -> Column:
        # The order and the marks are not part of the value.
        kind = F.when(at["rows"] == DAYS[0], F.lit("date")).otherwise(F.substring(at["kind"], 5, 9))
        other = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{key}|"), kind), 256), 1, 12), 16, 10).cast("long")
        # 29 February goes to another leap year.
        next_leap = (at["number"] + other % (len(LEAP) - 1) + 1) % len(LEAP)
        new = F.when(at["rows"] == 1, next_leap).otherwise(permuted_number(at["number"], key, kind, at["rows"], at["columns"]))
        return F.struct(at["kind"].alias("kind"), new.cast("int").alias("number"))

    def written(at: Column) -> Column:
        shape, number = F.substring(at["kind"], 5, 9), at["number"]
        year = F.when(shape == "leap", F.element_at(F.array(*map(F.lit, LEAP)), number + 1))
        both = F.when(shape == "leap", F.lit("2|29"))
        for name, slots in SHORT.items():
            year = year.when(shape == name, (F.floor(number / len(slots)) + 1800).cast("string"))
            both = both.when(shape == name, F.element_at(F.array(*map(F.lit, slots)), number % len(slots) + 1))
        new = {"y": year, "M": F.substring_index(both, "|", 1), "d": F.substring_index(both, "|", -1)}
        out = F.call_function("date_format", F.date_add(F.lit(YEARS_FROM).cast("date"), number), at["kind"])
        for order in ORDERS:
            out = F.when(at["kind"].startswith(f"{order}|"), F.concat(new[order[0]], mark, new[order[1]], mark, new[order[2]])).otherwise(out)
        return out

    first = F.coalesce(*whole, *short)
    return F.when(first.isNotNull(), F.element_at(F.transform(F.transform(F.array(first), moved), written), 1))


def _secret(value: Column, key: str) -> Column:
    lead = F.regexp_extract(value, r"^[\w-]+[\"']?\s*[=:]\s*[\"']?", 0)
    rest = F.substring(value, F.length(lead) + 1, F.length(value))
    new = F.when(rest.rlike("^[0-9a-f]+$"), permuted_text(rest, key, "hex", 6)).otherwise(permuted_text(rest, key, "secret"))
    return F.concat(lead, new)


def _after(value: Column, kept: int, key: str, kind: str) -> Column:
    return F.concat(
        F.substring(value, F.lit(1), F.lit(kept)), permuted_text(F.substring(value, F.lit(kept + 1), F.length(value)), key, kind)
    )


def _email(value: Column, key: str) -> Column:
    return F.concat(permuted_text(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    # The first digit of a country's code stays; what follows +1 is a number as it is written without.
    kept = F.when(value.startswith("+"), 1).otherwise(0)
    new = F.concat(F.substring(digits, F.lit(1), kept), permuted_text(F.substring(digits, kept + 1, F.length(digits)), key, "phone"))
    return F.when(F.length(digits).between(8, 15), in_layout(value, new))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match of the pattern, or the value itself if its check fails."""
    replaced = {
        "secret": _secret(value, key), "iban": _iban(value, key), "email": _email(value, key), "ip": _ip(value, key), "phone": _phone(value, key),
        "ssn": permuted_text(value, key, "ssn"), "date": _date(value, key), "card": _card(value, key),
        "key": _after(value, 4, key, "key"),
    }
    out = value
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.coalesce(replaced[kind], value)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str = "paceline", text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; ``found`` names a column for how many were."""
    whole = F.col(text)
    matches = F.regexp_extract_all(whole, F.lit(PATTERN), F.lit(0))
    new = F.transform(matches, lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))
    has = whole.rlike(NEEDED) & whole.rlike(PATTERN)
    none = F.array().cast("array<struct<old:string,new:string>>")
    pairs = fresh(docs, "pairs")
    named = docs.withColumn(pairs, F.when(has, new).otherwise(none))
    pieces = F.zip_with(F.split(whole, PATTERN, -1), F.col(pairs), lambda p, m: F.concat(p, F.coalesce(m["new"], F.lit(""))))
    out = named.withColumn(text, F.when(F.size(pairs) > 0, F.array_join(pieces, "")).otherwise(whole))
    if found:
        out = out.withColumn(found, F.size(F.filter(pairs, lambda p: p["old"] != p["new"])))
    return out.drop(pairs)
