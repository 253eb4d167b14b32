"""Format-preserving pseudonyms for numbers and dates, by keyed Feistel permutations.

Found in a text and validated: dates (2024-01-31, 31.01.2024, 01/31/2024), IPv4 addresses
(octets to 255), US social security numbers (assignable areas), North American phone
numbers (area and exchange from 200) and payment card numbers (13 to 19 digits, Luhn), also
beside and amid other groups of digits.

A value is written as a pair (l, r) in Z_a x Z_b, a product that covers its format exactly.
Eight rounds add a keyed SHA-256 of one half to the other, so values of a format are
permuted among themselves: equal values get equal pseudonyms in all documents, different
values different ones, and a pseudonym passes the same validation.  Signs between digits
stay where they are; of a card the first digit stays and the check digit is made anew.

DataFrame functions only; a document is changed where it is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
SHAPES = {
    "iso": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "dotted": r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])",
    "slashed": r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (r"(?<![0-9])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])"
              r"[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"),
    # Also longer runs of digits: a card may stand in the midst of other groups.
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+(?![0-9])",
}
PATTERN = "|".join(SHAPES.values())
#: Phone numbers written in full whose area or exchange starts with 0 or 1 (never assigned).
ANY_AREA = r"(?<![0-9])\+1[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
DATES = {"iso": "yyyy-MM-dd", "dotted": "dd.MM.yyyy", "slashed": "MM/dd/yyyy"}
#: Characters of a card with a sign between all digits.
LONGEST_CARD = 37
#: 271 * 271 days from here on (to 2101-01-26) are the dates that get pseudonyms.
FIRST_DAY, DAY_BASE = "1900-01-01", 271


def feistel(left: Column, a: Column, right: Column, b: Column, name: str, key: str) -> Column:
    """A keyed permutation of Z_a x Z_b, as a struct (l, r) of longs."""
    left, right, a, b = (c.cast("long") for c in (left, right, a, b))

    def keyed(i: Column, value: Column) -> Column:
        said = F.concat_ws("|", F.lit(key), F.lit(name), a, b, i, value)
        digest = F.sha2(said.cast("binary"), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        moved = F.when(even, (s["l"] + keyed(i, s["r"]) % a) % a).otherwise((s["r"] + keyed(i, s["l"]) % b) % b)
        return F.struct(F.when(even, moved).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(moved).alias("r"))

    start = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def put_digits(m: Column, digits: Column) -> Column:
    """The signs of ``m`` with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            F.when(digit, s["n"] + 1).otherwise(s["n"]).alias("n"))

    return F.aggregate(F.split(m, ""), start, step, lambda s: s["out"])


def _date(m: Column, style: str, key: str) -> Column:
    """The pseudonym of a valid date, else null."""
    first = F.lit(FIRST_DAY).cast("date")
    day = F.datediff(F.try_to_timestamp(m, F.lit(DATES[style])).cast("date"), first)
    base = F.lit(DAY_BASE)
    new = feistel(F.floor(day / DAY_BASE), base, day % DAY_BASE, base, "date", key)
    shifted = F.date_format(F.date_add(first, (new["l"] * DAY_BASE + new["r"]).cast("int")), DATES[style])
    return F.when((day >= 0) & (day < DAY_BASE**2), shifted)


def _ip(m: Column, key: str) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    half = F.lit(65536)
    new = feistel(F.get(part, 0) * 256 + F.get(part, 1), half, F.get(part, 2) * 256 + F.get(part, 3), half, "ip", key)
    text = F.concat_ws(".", *[x.cast("string") for x in (
        F.floor(new["l"] / 256), new["l"] % 256, F.floor(new["r"] / 256), new["r"] % 256)])
    # Zeros in front would be another way to write an address; such text is left alone.
    plain = F.concat_ws(".", F.transform(part, lambda x: x.cast("string"))) == m
    return F.when(plain & F.forall(part, lambda x: x <= 255), text)


def _ssn(m: Column, key: str) -> Column:
    digits = _digits(m)
    area, group, serial = (F.substring(digits, i, n).cast("int") for i, n in ((1, 3), (4, 2), (6, 4)))
    good = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    new = feistel(F.when(area > 666, area - 2).otherwise(area - 1), F.lit(898),
                  (group - 1) * 9999 + serial - 1, F.lit(99 * 9999), "ssn", key)
    back = F.when(new["l"] >= 665, new["l"] + 2).otherwise(new["l"] + 1)
    text = F.concat(_padded(back, 3), _padded(F.floor(new["r"] / 9999) + 1, 2), _padded(new["r"] % 9999 + 1, 4))
    return F.when(good, put_digits(m, text))


def _phone(m: Column, key: str) -> Column:
    digits = _digits(m)
    own = F.substring(digits, -10, 10)
    area, rest = F.substring(own, 1, 3).cast("int"), F.substring(own, 4, 7).cast("int")
    # Areas below 200, and exchanges below 200, are permuted among themselves.
    low, odd = F.when(area < 200, 0).otherwise(200), F.when(rest < 2_000_000, 0).otherwise(2_000_000)
    new = feistel(area - low, F.when(area < 200, 200).otherwise(800),
                  rest - odd, F.when(rest < 2_000_000, 2_000_000).otherwise(8_000_000), "phone", key)
    before = F.substring(digits, 1, F.length(digits) - 10)
    return put_digits(m, F.concat(before, _padded(new["l"] + low, 3), _padded(new["r"] + odd, 7)))


def _whole_card(m: Column, key: str) -> Column:
    """The pseudonym of a card number (13 to 19 digits) without anything around it, else null."""
    def of(digits: Column) -> Column:
        body = F.length(digits) - 2
        left = F.floor(body / 2).cast("int")
        right = body - left
        power = lambda n: F.element_at(F.array(*[F.lit(10**i) for i in range(10)]), (n + 1).cast("int"))
        new = feistel(F.substr(digits, F.lit(2), left), power(left), F.substr(digits, left + 2, right), power(right), "card", key)

        def checked(n: Column) -> Column:
            text = F.concat(F.substring(digits, 1, 1), F.lpad(n["l"].cast("string"), left, F.lit("0")),
                            F.lpad(n["r"].cast("string"), right, F.lit("0")))
            every = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(text, c.cast("string")))
            return put_digits(m, F.get(F.filter(every, lambda x: F.call_function("luhn_check", x)), 0))

        return F.when(_is_card(digits), _bound(new, checked))

    return F.when(F.length(m) <= LONGEST_CARD, _bound(_digits(m), of))


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _long_run(m: Column, key: str) -> Column:
    """A run of more than 19 digits with its cards replaced, else null.

    From left to right, the longest run of whole groups that is a card is replaced and the
    search goes on behind it, so no card is left whole; a group starts at most 19 runs.
    """
    groups = F.split(m, "[ -]")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("next"), F.lit(1).alias("at"))

    def step(s: Column, i: Column) -> Column:
        group = F.get(groups, i)

        def length(j: Column) -> Column:
            return F.aggregate(F.slice(groups, i + 1, j - i + 1), F.lit(-1), lambda n, g: n + F.length(g) + 1)

        last = F.least(i + 18, F.size(groups) - 1)
        # Only what a card can reach is looked at, however long the run is.
        near = F.substr(m, s["at"], F.lit(LONGEST_CARD))
        parts = F.transform(F.sequence(last, i, F.lit(-1)), lambda j: F.struct((j + 1).alias("next"), length(j).alias("n")))
        parts = F.filter(parts, lambda p: p["n"] <= LONGEST_CARD)
        parts = _bound(near, lambda text: F.transform(parts, lambda p: F.struct(
            p["next"].alias("next"), F.substr(text, F.lit(1), p["n"]).alias("m"))))
        found = F.get(F.filter(parts, lambda p: _is_card(_digits(p["m"]))), 0)
        sign = F.substr(m, s["at"] - 1, F.when(i > 0, 1).otherwise(0))
        past = s["at"] + F.length(group) + 1
        taken = _bound(found, lambda f: F.when(f.isNotNull(), F.struct(
            F.concat(s["out"], sign, _whole_card(f["m"], key)).alias("out"), f["next"].alias("next"), past.alias("at"))))
        return F.when(i < s["next"], F.struct(s["out"].alias("out"), s["next"].alias("next"), past.alias("at"))).otherwise(
            F.coalesce(taken, F.struct(F.concat(s["out"], sign, group).alias("out"), (i + 1).alias("next"), past.alias("at"))))

    new = F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda s: s["out"])
    return F.when(F.size(groups) > 1, _bound(new, lambda n: F.when(n != m, n)))


def _card(m: Column, key: str) -> Column:
    """The pseudonym of a run of digits that is a card number, or whose digit groups hold
    one: of the runs of whole groups that pass, the longest, and of those the first."""
    groups = F.split(m, "[ -]")

    def start(i: Column) -> Column:
        """How many characters stand before group ``i``."""
        return F.aggregate(F.slice(groups, 1, i), F.lit(0), lambda n, g: n + F.length(g) + 1)

    def runs(i: Column) -> Column:
        return F.transform(F.sequence(i, F.size(groups) - 1), lambda j: F.struct(
            start(i).alias("at"), (start(j + 1) - start(i) - 1).alias("n")))

    def part(r: Column) -> Column:
        return F.substr(m, r["at"] + 1, r["n"])

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.size(groups) - 1), runs))
    found = F.filter(every, lambda r: _is_card(_digits(part(r))))
    # Sorted by digits, longest first, then by place.
    best = F.get(F.array_sort(F.transform(found, lambda r: F.struct(
        (-F.length(_digits(part(r)))).alias("d"), r["at"].alias("at"), r["n"].alias("n")))), 0)
    inner = _bound(best, lambda b: F.concat(
        F.substr(m, F.lit(1), b["at"]), _whole_card(part(b), key), F.substr(m, b["at"] + b["n"] + 1, F.length(m))))
    short = F.coalesce(_whole_card(m, key), F.when(F.size(groups) > 1, inner))
    return F.when(F.length(_digits(m)) <= 19, short).otherwise(_long_run(m, key))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a found piece, null where validation fails."""
    def shaped(name: str) -> Column:
        return m.rlike(f"^(?:{SHAPES[name]})$")

    return (
        F.when(shaped("iso"), _date(m, "iso", key))
        .when(shaped("dotted"), _date(m, "dotted", key))
        .when(shaped("slashed"), _date(m, "slashed", key))
        .when(shaped("ip"), _ip(m, key))
        .when(shaped("ssn"), _ssn(m, key))
        .when(shaped("phone") | m.rlike(f"^(?:{ANY_AREA})$"), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text", any_area: bool = False) -> DataFrame:
    """The input rows and columns, with ``text`` rewritten, and two more columns:
    ``_numbers`` and ``_dates``, how many of each were replaced.

    ``any_area`` takes phone numbers like +1 (017) 155-7713 too, whose area or exchange is
    below 200.  ``key`` is the secret; the same key gives the same pseudonyms in every run.
    A null text stays null, a text without validated values stays as it is.  Other columns
    and repeated rows pass through; only input columns that are named like the two new ones
    are replaced by them.  An empty table gives no rows.
    """
    # Positions, since the documents may have columns named like ours.
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = F.col(names[docs.columns.index(text)])
    pattern = f"{PATTERN}|{ANY_AREA}" if any_area else PATTERN
    none = F.array().cast("array<string>")
    df = docs.toDF(*names)
    df = df.withColumn("found", F.when(own.rlike("[0-9]"), F.regexp_extract_all(own, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("new", F.transform("found", lambda m: pseudonym(m, key)))
    placed = F.zip_with(F.split(own, pattern, -1), F.concat(F.zip_with("new", "found", lambda n, f: F.coalesce(n, f)), F.array(F.lit(""))),
                        lambda a, b: F.concat(a, b))
    dates = "|".join(SHAPES[s] for s in DATES)
    done = F.zip_with("new", "found", lambda n, f: F.when(n.isNotNull(), f))
    df = df.withColumn("done", F.filter(done, lambda f: f.isNotNull()))
    is_date = F.filter("done", lambda f: f.rlike(f"^(?:{dates})$"))
    changed = F.when(F.size("done") > 0, F.array_join(placed, "")).otherwise(own)
    own_names = ("_numbers", "_dates")
    kept_columns = [(n, c) for n, c in zip(names, docs.columns) if c not in own_names]
    return df.select(
        *[changed if c == text else F.col(n) for n, c in kept_columns],
        F.size("done") - F.size(is_date), F.size(is_date)).toDF(*[c for _, c in kept_columns], *own_names)
