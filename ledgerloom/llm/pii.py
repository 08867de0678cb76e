"""Format-preserving pseudonyms for personal data, by Feistel networks in Spark expressions.

Numbers and dates that pass their validation are permuted within their format: a card
number becomes a card number with a right check digit, an address an address, a date a
date. The permutation depends on the key and the kind alone, so equal values stay equal in
all documents, and whoever holds the key can take it back. No Python runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The session's setting that holds the key: whoever knows it can take all pseudonyms back.
KEY_SETTING = "spark.ledgerloom.pii.key"
#: Even rounds move the left half, odd ones the right half.
ROUNDS = 8

_DAY = r"(?:0[1-9]|[12][0-9]|3[01])"
_MONTH = r"(?:0[1-9]|1[0-2])"
_YEAR = r"(?:1[89]|2[01])[0-9]{2}"
#: Country codes that are given, but 1.
_COUNTRY = "(?:7|2[07]|2[1-689][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[789][0-9]|8[1246]|8[0578][0-9]|9[0-58]|9[679][0-9])"
#: A foreign number ends before a card.
_CARD_AHEAD = "[0-9]{13}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
#: Kinds and what they look like; the first that fits a place is taken.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])",
    "date": rf"(?<![0-9./-])(?:{_YEAR}-{_MONTH}-{_DAY}|{_DAY}[./]{_MONTH}[./]{_YEAR})(?![./-]?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "phone": (
        r"(?:(?<![0-9+])(?:\+1[ .-]?\(?[0-9]{3}\)?|\([0-9]{3}\))[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
        r"|(?<![A-Za-z0-9_+])(?<![0-9][./-])[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )[0-9]{4}(?![A-Za-z0-9]|[.-][0-9])"
        rf"|(?<![A-Za-z0-9+])\+{_COUNTRY}(?:(?:[ ./-](?!{_CARD_AHEAD})| ?\(|\) ?)?[0-9]){{6,12}}(?![A-Za-z0-9]))"
    ),
    "key": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{32,64})(?![A-Za-z0-9])",
}
#: A run of groups of digits, 13 digits at least; none of its later groups begins another kind. Cards are looked for inside.
PATTERNS["card"] = (
    r"(?<![A-Za-z0-9])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])"
    rf"(?:[ -](?!{'|'.join(PATTERNS.values())})[0-9]++(?![A-Za-z]))*+"
)
ANY = "|".join(PATTERNS.values())
#: How the numbers of known issuers begin, with their lengths, and how they are written in groups.
_ISSUED = "^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7]|35)[0-9]{14}|3[47][0-9]{13}|3[068][0-9]{12}|6[0-9]{15,18})$"
_WRITTEN = "^(?:[0-9]+|[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\\2[0-9]{5})$"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _long(x: Column) -> Column:
    return x.cast("long")


def _digest(key: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the pairs below ``left_size`` and ``right_size``: a struct (l, r)."""
    by = lambda turn, value: _long(F.conv(F.substring(_digest(key, kind, turn, value), 1, 15), 16, 10))
    pair = lambda l, r: F.struct(_long(l).alias("l"), _long(r).alias("r"))  # noqa: E731, E741

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, pair(F.pmod(s["l"] + by(i, s["r"]), _long(left_size)), s["r"])).otherwise(
            pair(s["l"], F.pmod(s["r"] + by(i, s["l"]), _long(right_size)))
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair(left, right), turn)


def _shifted(text: Column, digest: Column, alphabets: list[str]) -> Column:
    """Each character moved within its alphabet by a byte of ``digest``; others stay."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        found = c
        for letters in alphabets:
            at = F.instr(F.lit(letters), c)
            found = F.when(
                at > 0, F.substring(F.lit(letters), F.pmod(at - 1 + by, F.lit(len(letters))) + 1, F.lit(1))
            ).otherwise(found)
        return found

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(F.split(text, ""), move), ""))


def feistel_text(text: Column, key: str, kind: str, alphabets: list[str]) -> Column:
    """A keyed permutation of the strings of one format, of up to 64 characters."""
    half = F.floor(F.length(text) / 2).cast("int")
    pair = lambda l, r: F.struct(l.alias("l"), r.alias("r"))  # noqa: E731, E741

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, pair(_shifted(s["l"], _digest(key, kind, i, s["r"]), alphabets), s["r"])).otherwise(
            pair(s["l"], _shifted(s["r"], _digest(key, kind, i, s["l"]), alphabets))
        )

    start = pair(F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.lit(64)))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return F.concat(done["l"], done["r"])


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, every second one doubled, beginning with place ``doubled``."""

    def place(i: Column) -> Column:
        x = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == doubled % 2, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), place), F.lit(0), lambda a, b: a + b)


def _filled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def add(s: Column, c: Column) -> Column:
        return F.when(
            c.between("0", "9"),
            F.struct(F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))

    return F.aggregate(F.split(value, ""), start, add)["out"]


def _pad(x: Column, n: int | Column) -> Column:
    return F.lpad(x.cast("string"), n if isinstance(n, Column) else F.lit(n), F.lit("0"))


def _card(value: Column, key: str) -> Column:
    """Null unless the check digit is right; the first digit stays."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    inner = F.substring(digits, F.lit(2), F.length(digits) - 2)
    a = F.floor(F.length(inner) / 2).cast("int")
    b = F.length(inner) - a
    size = lambda n: F.pow(F.lit(10.0), n)
    kind = F.substring(inner, F.lit(1), a), F.substring(inner, a + 1, b)
    new = feistel(_long(kind[0]), _long(kind[1]), size(a), size(b), key, "card")
    body = F.transform(F.array(new), lambda x: F.concat(F.substring(digits, 1, 1), _pad(x["l"], a), _pad(x["r"], b)))[0]
    full = F.transform(F.array(body), lambda x: F.concat(x, F.pmod(-_luhn(x, 1), F.lit(10)).cast("string")))[0]
    return F.when(_valid_card(value), _filled(value, full))


def _valid_card(written: Column) -> Column:
    digits = F.regexp_replace(written, "[^0-9]", "")
    return F.length(digits).between(13, 19) & (_luhn(digits, 0) % 10 == 0)


def _groups(run: Column) -> Column:
    """The text of a match and its groups of digits, each with the mark after it; no groups unless it is a run without a right check digit."""
    cut = run.rlike("^[0-9]+[ -][0-9 -]+$") & (F.length(run) > 13) & ~_valid_card(run)
    groups = F.when(cut, F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.struct(run.alias("text"), groups.alias("groups"))


def _written(groups: Column, first: Column, count: Column) -> Column:
    """``count`` groups from ``first`` (0 is the first) on, with the mark after the last one."""
    return F.array_join(F.slice(groups, first + 1, count), "")


def _rated(run: Column) -> Column:
    """For each group the best card that begins there: rank, length, how many groups; or null.

    Those written as cards are are best, then those of known issuers, the longer ones first.
    Others are no cards: in a long row of numbers some run always has a right check digit.
    """

    def rated(x: Column) -> Column:
        written = x["written"]
        rank = F.when(written.rlike(_WRITTEN), 2).when(F.regexp_replace(written, "[^0-9]", "").rlike(_ISSUED), 1)
        return F.when(
            (rank > 0) & _valid_card(written),
            F.struct(rank.alias("rank"), F.length(written).alias("size"), x["groups"].alias("groups")),
        )

    def best(near: Column) -> Column:
        starts = F.transform(
            F.sequence(F.lit(1), F.size(near)),
            lambda k: F.struct(F.rtrim(_written(near, F.lit(0), k), F.lit(" -")).alias("written"), k.alias("groups")),
        )
        return F.array_max(F.transform(F.filter(starts, lambda x: F.length(x["written"]).between(13, 37)), rated))

    # a card has 19 groups at most
    near = F.transform(run["groups"], lambda _, i: F.slice(run["groups"], i + 1, 19))
    return F.struct(run["text"].alias("text"), run["groups"].alias("groups"), F.transform(near, best).alias("best"))


def _cut(run: Column) -> Column:
    """From left to right the best card at a group, unless a better one begins inside it: (first group, groups) of each.

    Cards are gathered in lists of some hundreds, so that the time grows with their number and not its square.
    """
    kind = "array<struct<i:int,groups:int>>"
    start = F.struct(
        F.array().cast(f"array<{kind}>").alias("full"), F.array().cast(kind).alias("cards"), F.lit(0).alias("next"), F.lit(0).alias("i")
    )

    def step(s: Column, own: Column) -> Column:
        inside = F.slice(run["best"], s["i"] + 2, F.greatest(own["groups"] - 1, F.lit(0)))
        card = (s["i"] >= s["next"]) & own.isNotNull() & ~F.exists(inside, lambda x: F.coalesce(x["rank"] > own["rank"], F.lit(False)))
        full = F.size(s["cards"]) >= 500
        taken = F.struct(s["i"].alias("i"), own["groups"].alias("groups"))
        return F.when(
            card,
            F.struct(
                F.when(full, F.array_append(s["full"], s["cards"])).otherwise(s["full"]).alias("full"),
                F.when(full, F.array(taken)).otherwise(F.array_append(s["cards"], taken)).alias("cards"),
                (s["i"] + own["groups"]).alias("next"),
                (s["i"] + 1).alias("i"),
            ),
        ).otherwise(F.struct(s["full"].alias("full"), s["cards"].alias("cards"), s["next"].alias("next"), (s["i"] + 1).alias("i")))

    cards = F.aggregate(run["best"], start, step, lambda s: F.concat(F.flatten(s["full"]), s["cards"]))
    return F.struct(run["text"].alias("text"), run["groups"].alias("groups"), cards.alias("cards"))


def _pieces(run: Column) -> Column:
    """The match in pieces (text, whether it is a value): whole, or before, in and after its cards."""
    piece = lambda text, value: F.struct(text.alias("text"), F.lit(value).alias("value"))
    groups, cards = run["groups"], run["cards"]

    def mark_before(group: Column) -> Column:
        return F.when(group == 0, "").otherwise(F.regexp_extract(F.get(groups, group - 1), "[ -]$", 0))

    def around(c: Column, n: Column) -> Column:
        before = F.when(n == 0, F.lit(0)).otherwise(F.get(cards, n - 1)["i"] + F.get(cards, n - 1)["groups"])
        end = c["i"] + c["groups"]
        last = n + 1 == F.size(cards)
        # the mark after a card goes with what follows
        gap = F.concat(mark_before(before), _written(groups, before, c["i"] - before))
        card = F.rtrim(_written(groups, c["i"], c["groups"]), F.lit(" -"))
        rest = F.when(last, F.concat(mark_before(end), _written(groups, end, F.size(groups) - end))).otherwise("")
        return F.array(piece(gap, False), piece(card, True), piece(rest, False))

    return F.when(F.size(cards) > 0, F.flatten(F.transform(cards, around))).otherwise(F.array(piece(run["text"], True)))


def _ip(value: Column, key: str) -> Column:
    """Null unless all parts are below 256 and without leading zeros."""
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    new = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536), key, "ip")
    text = F.transform(
        F.array(new),
        lambda x: F.concat_ws(".", F.shiftright(x["l"], 8), x["l"] % 256, F.shiftright(x["r"], 8), x["r"] % 256),
    )[0]
    return F.when(F.forall(parts, lambda x: x < 256) & (F.concat_ws(".", parts.cast("array<string>")) == value), text)


def _phone(value: Column, key: str) -> Column:
    return F.when(value.rlike(r"^\+[2-9]"), _foreign(value, key)).otherwise(_american(value, key))


def _foreign(value: Column, key: str) -> Column:
    """The country code stays."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    front = F.length(F.regexp_extract(digits, f"^{_COUNTRY}", 0))
    a = F.floor((F.length(digits) - front) / 2).cast("int")
    b = F.length(digits) - front - a
    left, right = F.substring(digits, front + 1, a), F.substring(digits, front + a + 1, b)
    new = feistel(_long(left), _long(right), F.pow(F.lit(10.0), a), F.pow(F.lit(10.0), b), key, "phone")
    full = lambda x: F.concat(F.substring(digits, F.lit(1), front), _pad(x["l"], a), _pad(x["r"], b))
    return _filled(value, F.transform(F.array(new), full)[0])


def _american(value: Column, key: str) -> Column:
    """The country code stays, and whether area and exchange begin with 0 or 1, as no real ones do."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    front = F.length(digits) - 10
    area, exchange = (F.substring(digits, front + k, F.lit(3)).cast("int") for k in (1, 4))
    line = F.substring(digits, front + 7, F.lit(4)).cast("int")
    least = [F.when(x >= 200, 200).otherwise(0) for x in (area, exchange)]
    sizes = [F.when(x >= 200, 800).otherwise(200) for x in (area, exchange)]
    new = feistel(
        (area - least[0]) * sizes[1] + exchange - least[1], line, sizes[0] * sizes[1], F.lit(10_000), key, "phone"
    )
    return _filled(
        value,
        F.transform(
            F.array(new),
            lambda x: F.concat(
                F.substring(digits, F.lit(1), front),
                _pad(F.floor(x["l"] / sizes[1]) + least[0], 3),
                _pad(x["l"] % sizes[1] + least[1], 3),
                _pad(x["r"], 4),
            ),
        )[0],
    )


def _ssn(value: Column, key: str) -> Column:
    """Null for areas 000, 666 and from 900 on, group 00 and serial 0000, which are never given."""
    area, group, serial = (F.substring(value, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    at = area - F.when(area > 666, 2).otherwise(1)
    new = feistel(at * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def text(x: Column) -> Column:
        place = F.floor(x["l"] / 99)
        return F.concat_ws("-", _pad(place + F.when(place >= 665, 2).otherwise(1), 3), _pad(x["l"] % 99 + 1, 2), _pad(x["r"] + 1, 4))

    right = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    return F.when(right, F.transform(F.array(new), text)[0])


def _date(value: Column, key: str) -> Column:
    """A day of 1800 to 2199, all but the last 97 days of that; null for days that no calendar has."""
    iso = F.substring(value, 5, 1) == "-"
    plain = F.when(iso, value).otherwise(
        F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2))
    )
    day = F.try_to_date(plain, "yyyy-MM-dd")
    at = F.datediff(day, F.lit("1800-01-01").cast("date"))
    new = feistel(F.floor(at / 365), at % 365, F.lit(400), F.lit(365), key, "date")

    def text(x: Column) -> Column:
        d = F.date_add(F.lit("1800-01-01").cast("date"), (x["l"] * 365 + x["r"]).cast("int"))
        mark = F.substring(value, 3, 1)
        other = F.concat(F.date_format(d, "dd"), mark, F.date_format(d, "MM"), F.substring(value, 6, 1), F.date_format(d, "yyyy"))
        return F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(other)

    return F.when(day.isNotNull() & at.between(0, 400 * 365 - 1), F.transform(F.array(new), text)[0])


def _email(value: Column, key: str) -> Column:
    """The part before the sign; the domain stays."""
    at = F.instr(value, "@")
    return F.concat(
        feistel_text(F.substring(value, F.lit(1), at - 1), key, "email", [_LOWER, _UPPER, _DIGITS]),
        F.substring(value, at, F.length(value)),
    )


def _key(value: Column, key: str) -> Column:
    body = F.substring(value, F.lit(5), F.length(value))
    return F.when(
        value.startswith("AKIA"), F.concat(F.lit("AKIA"), feistel_text(body, key, "key", [_UPPER + _DIGITS]))
    ).otherwise(feistel_text(value, key, "hex", [_DIGITS + "abcdef"]))


_RULES = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "key": _key, "card": _card}


def _replaced(value: Column, key: str) -> Column:
    """A struct of the kind, null where validation fails, and what stands in the value's place."""
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)

    def by_kind(k: Column) -> Column:
        new = F.lit(None).cast("string")
        for name, rule in _RULES.items():
            new = F.when(k == name, rule(value, key)).otherwise(new)
        return F.struct(k.alias("kind"), new.alias("new"))

    def keep(x: Column) -> Column:
        return F.struct(
            F.when(x["new"].isNotNull(), x["kind"]).alias("kind"), F.coalesce(x["new"], value).alias("new")
        )

    return F.transform(F.transform(F.array(kind), by_kind), keep)[0]


def _key_of(docs: DataFrame, key: str | None) -> str:
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"no key: give one or set {KEY_SETTING}")
    return key


def pseudonymize(docs: DataFrame, key: str | None = None, text: str = "text", found_in: str = "pii") -> DataFrame:
    """All columns of ``docs`` with the text rewritten, and ``found_in``: an array of structs (kind, new).

    The array has an entry for each place that looks like personal data; its kind is null
    where validation failed and the text stayed. Several cards in one run of numbers have an
    entry each. A null text stays null with an empty
    array; texts without such places are unchanged. An existing column ``found_in`` is
    replaced. Repeated rows get equal results. Without ``key`` the session's ``KEY_SETTING`` is
    taken; without either, an error is raised.
    """
    key = _key_of(docs, key)
    column = F.col(f"`{text}`")
    # most texts have neither a digit nor an address sign, and are looked at no further
    maybe = F.coalesce(column.rlike("[0-9@]"), F.lit(False))
    places = F.when(maybe, F.regexp_extract_all(column, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    runs = F.transform(F.transform(F.transform(F.transform(places, _groups), _rated), _cut), _pieces)
    pieces = F.flatten(
        F.zip_with(
            F.split(column, ANY, -1),
            runs,
            lambda gap, run: F.concat(F.array(F.struct(gap.alias("text"), F.lit(False).alias("value"))), F.coalesce(run, F.array())),
        )
    )
    kept = lambda x: F.struct(F.lit(None).cast("string").alias("kind"), x["text"].alias("new"), x["value"].alias("value"))

    def changed(x: Column) -> Column:
        value = lambda r: F.struct(r["kind"].alias("kind"), r["new"].alias("new"), F.lit(True).alias("value"))
        return F.when(x["value"], F.transform(F.array(_replaced(x["text"], key)), value)[0]).otherwise(kept(x))

    none = F.array().cast("array<struct<kind:string,new:string,value:boolean>>")
    found = docs.withColumn(found_in, F.when(F.size(places) > 0, F.transform(pieces, changed)).otherwise(none))
    every = F.col(f"`{found_in}`")
    entries = F.transform(F.filter(every, lambda x: x["value"]), lambda x: F.struct(x["kind"].alias("kind"), x["new"].alias("new")))
    joined = F.when(F.size(every) > 0, F.array_join(every["new"], "")).otherwise(column)
    return found.withColumns({text: joined, found_in: entries})


def counted(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``doc_id``, the rewritten ``text``, and how many values of each kind were replaced."""
    done = pseudonymize(docs.select("doc_id", "text"), key)
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")
    return done.select("doc_id", "text", *(count(kind).alias(f"n_{kind}") for kind in PATTERNS))
