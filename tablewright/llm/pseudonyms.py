"""Format-preserving pseudonyms by keyed Feistel permutations.

Validated numbers and dates are mapped one to one onto values of the same
format: a card number stays a card number with a right check digit, a date a
date. The map depends on the key and the kind only, so equal values stay linked
across documents. Built-in functions only; the round function is SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import let, scanned

ROUNDS = 8
# Fixed patterns. Each starts where no longer candidate could have started.
# Possessive, so the engine repeats them without a call for each repetition.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
YEAR_FIRST = r"(?<![0-9])(?:18|19|20|21)[0-9]{2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{1,2}(?![0-9])"
YEAR_LAST = r"(?<![0-9])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.|-[0-9]{1,2}-)(?:18|19|20|21)[0-9]{2}(?![0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
SOCIAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
# A whole run of numbers, at least seven digits; ``parts_of`` finds the values in it.
NUMBER = (
    r"(?<![0-9A-Za-z])\+?\(?(?=[0-9](?:[ ().-]{0,2}[0-9]){6})"
    r"[0-9]++(?![A-Za-z])(?:[ ().-]{1,2}[0-9]++(?![A-Za-z]))*+"
)
NANP = r"(?:\+?1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}"
# Card numbers as they are printed: in one piece, or in groups with one separator.
CARD = r"[0-9]{13,19}|[0-9]{4}([ .-])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{6}\1[0-9]{4,5})"
ANY = "|".join((EMAIL, IBAN, YEAR_FIRST, YEAR_LAST, IP, SOCIAL, NUMBER))

# Between two characters.
BETWEEN = "(?s)(?<=.)(?=.)"

# A piece of a match and its kind.
PIECE = "struct<s:string,k:string>"

KINDS = ("email", "iban", "date", "ip", "social", "card", "phone")


def prf(key: str, kind: str, turn: Column, value: Column) -> Column:
    """60 bits of SHA-256 of key, kind, round and value."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def halves(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Permutes the pairs of 0 to ``a - 1`` and 0 to ``b - 1``: each half is
    shifted in turn by a keyed function of the other."""

    def turn(state: Column, i: Column) -> Column:
        new_left = F.pmod(state["l"] + F.pmod(prf(key, kind, i, state["r"]), a), a)
        new_right = F.pmod(state["r"] + F.pmod(prf(key, kind, i, state["l"]), b), b)
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, new_left).otherwise(state["l"]).alias("l"), F.when(odd, state["r"]).otherwise(new_right).alias("r")
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.alias("l"), right.alias("r")), turn)


def feistel(value: Column, a: int, b: int, key: str, kind: str) -> Column:
    """Permutes 0 to ``a * b - 1``."""
    b_ = F.lit(b).cast("long")
    moved = halves(F.floor(value / b_).cast("long"), F.pmod(value, b_), F.lit(a).cast("long"), b_, key, kind)
    return let(moved, lambda pair: pair["l"] * b_ + pair["r"])


def power(n: Column) -> Column:
    """10 to the ``n``, exactly."""
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of up to 18 digits as another of the same length."""
    n = F.char_length(digits)
    low = F.floor(n / 2).cast("int")
    # the halves are cut from the string, so no number is divided
    a, b = power(n - low), power(low)
    zero = lambda part: F.coalesce(F.when(part != "", part).cast("long"), F.lit(0).cast("long"))
    left, right = F.substring(digits, F.lit(1), n - low), F.substring(digits, n - low + 1, low)
    return let(
        halves(zero(left), zero(right), a, b, key, kind),
        lambda pair: F.concat(F.lpad(pair["l"].cast("string"), n - low, "0"), F.lpad(pair["r"].cast("string"), low, "0")),
    )


def permuted_text(text: Column, key: str, kind: str) -> Column:
    """Letters and digits of a short string shifted within their class, the two
    halves in turn by a keyed function of the other; all else stays."""

    def shifted(part: Column, other: Column, i: Column) -> Column:
        def char(at: Column, digest: Column) -> Column:
            c = F.substring(part, at, F.lit(1))
            shift = F.conv(F.substring(digest, ((at - 1) % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")

            def within(first: str, size: int) -> Column:
                code = F.pmod(F.ascii(c) - ord(first) + shift, F.lit(size)) + ord(first)
                return F.char(code)

            return (
                F.when(c.rlike("^[0-9]$"), within("0", 10))
                .when(c.rlike("^[a-z]$"), within("a", 26))
                .when(c.rlike("^[A-Z]$"), within("A", 26))
                .otherwise(c)
            )

        n = F.char_length(part)

        def block(number: Column) -> Column:
            # one digest gives 32 shifts; longer parts take one digest for each 32 places
            digest = F.sha2(
                F.concat_ws(":", F.lit(key), F.lit(kind), i.cast("string"), number.cast("string"), other), 256
            )
            places = F.sequence(number * 32 + 1, F.least(number * 32 + 32, n))
            return let(digest, lambda d: F.array_join(F.transform(places, lambda at: char(at, d)), ""))

        blocks = F.sequence(F.lit(0), F.floor((n - 1) / 32).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(blocks, block), "")).otherwise(part)

    def turn(state: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, shifted(state["l"], state["r"], i)).otherwise(state["l"]).alias("l"),
            F.when(odd, state["r"]).otherwise(shifted(state["r"], state["l"], i)).alias("r"),
        )

    half = F.floor((F.char_length(text) + 1) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.char_length(text)).alias("r")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def refilled(pattern: Column, chars: Column, slot: str) -> Column:
    """``pattern`` with its characters of class ``slot`` replaced, in order, by ``chars``."""

    def filled(new: Column) -> Column:
        def put(state: Column, c: Column) -> Column:
            hit = c.rlike(slot)
            nxt = F.substring(new, state["k"] + 1, F.lit(1))
            return F.struct(
                F.concat(state["out"], F.when(hit, nxt).otherwise(c)).alias("out"),
                (state["k"] + F.when(hit, 1).otherwise(0)).alias("k"),
            )

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
        return F.aggregate(F.split(pattern, BETWEEN), start, put, lambda s: s["out"])

    return let(chars, filled)


def luhn_sum(digits: Column, shift: int) -> Column:
    """Luhn sum; ``shift`` 0 with the check digit in place, 1 before it is added."""

    def summed(number: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = F.substring(number, F.char_length(number) - i, F.lit(1)).cast("int")
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return total + F.when((i + shift) % 2 == 1, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), F.char_length(number) - 1), F.lit(0), add)

    return let(digits, summed)


def mod97(text: Column) -> Column:
    """The remainder by 97 of an account number with letters as 10 to 35."""

    def add(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, (rest * 10 + value) % 97).otherwise((rest * 100 + value) % 97)

    turned = F.concat(F.substring(text, F.lit(5), F.char_length(text)), F.substring(text, 1, 4))
    return F.aggregate(F.split(turned, BETWEEN), F.lit(0), add)


def date_parts(m: Column) -> Column:
    """The three numbers of a date as they are written."""
    return F.split(m, "[-/.]")


def date_from(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def day_of(m: Column) -> Column:
    """The date a match names, or NULL. With the year last the day comes first,
    unless only the month can."""
    p = date_parts(m)
    a, b, c = F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2))
    return F.when(F.char_length(a) == 4, date_from(a, b, c)).otherwise(F.coalesce(date_from(c, b, a), date_from(c, a, b)))


def month_first(m: Column) -> Column:
    """Whether a valid date with the year last has its month first: its second
    number is no month."""
    p = date_parts(m)
    return (F.char_length(F.get(p, F.lit(0))) < 3) & (F.get(p, F.lit(1)).cast("int") > 12)


def kind_of(m: Column) -> Column:
    """The validated kind of a match, or NULL if it is none."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.char_length(digits)
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(f"^(?:{IBAN})$"), F.when(mod97(bare) == 1, "iban"))
        .when(m.rlike(f"^(?:{YEAR_FIRST}|{YEAR_LAST})$"), F.when(day_of(m).isNotNull(), "date"))
        .when(m.rlike(f"^(?:{IP})$"), "ip")
        .when(m.rlike(f"^(?:{SOCIAL})$"), "social")
        .when(n.between(13, 19) & ~m.contains("+") & (luhn_sum(digits, 0) % 10 == 0), "card")
        .when(m.rlike(f"^(?:{NANP})$") | (m.startswith("+") & n.between(8, 15)), "phone")
    )


def strict_kind_of(m: Column, before: Column, after: Column) -> Column:
    """The kind of some numbers of a run by their spelling, or NULL; ``before``
    and ``after`` are what lies beside them."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    return (
        F.when(m.rlike(f"^(?:{YEAR_FIRST}|{YEAR_LAST})$"), F.when(day_of(m).isNotNull(), "date"))
        .when(m.rlike(f"^(?:{IP})$") & ~before.endswith(".") & ~after.rlike(r"^\.[0-9]"), "ip")
        .when(m.rlike(f"^(?:{SOCIAL})$") & ~before.endswith("-") & ~after.startswith("-"), "social")
        .when(m.rlike(f"^(?:{NANP})$"), "phone")
        .when(m.rlike(f"^(?:{CARD})$"), F.when(luhn_sum(digits, 0) % 10 == 0, "card"))
    )


def parts_of(m: Column) -> Column:
    """A match cut into plain pieces (``k`` is NULL) and values of a kind ``k``.

    In a run of numbers the values that are known by their spelling come first,
    from the left; what lies between them is validated as a whole, or piece by
    piece if it has more digits than a number can have.
    """
    part = lambda s, k: F.struct(s.alias("s"), k.alias("k"))
    none = F.lit(None).cast("string")
    lead = lambda s: F.regexp_extract(s, "^[^0-9+]*", 0)
    bare = lambda s: F.regexp_replace(s, "^[^0-9+]+", "")
    n_digits = lambda s: F.char_length(F.regexp_replace(s, "[^0-9]", ""))

    def values(numbers: Column) -> Column:
        def value_at(i: Column) -> Column:
            def tried(n: Column) -> Column:
                whole = F.array_join(F.slice(numbers, i + 1, n), "")
                after = F.coalesce(F.get(numbers, i + n), F.lit(""))
                kind = let(whole, lambda w: F.when(n_digits(w) >= 6, strict_kind_of(bare(w), lead(w), after)))
                return F.struct(n.alias("n"), F.when(i + n <= F.size(numbers), kind).alias("k"))

            # 16 digits come before 19, so a code behind a card stays apart
            sizes = F.array(*[F.lit(n) for n in (4, 5, 3, 2, 1)])
            return F.get(F.filter(F.transform(sizes, tried), lambda x: x["k"].isNotNull()), F.lit(0))

        return F.transform(F.sequence(F.lit(0), F.size(numbers) - 1), value_at)

    def cut(numbers: Column, found: Column) -> Column:
        """Pieces, those between the values marked as open."""

        none = F.array().cast(f"array<{PIECE}>")

        def add(state: Column, i: Column) -> Column:
            value, text = F.get(found, i), F.get(numbers, i)
            most = F.when(state["open"].startswith("+"), 15).otherwise(19)
            full = n_digits(F.concat(state["open"], text)) > most
            closed = F.when(state["open"] != "", F.array(part(state["open"], F.lit("open")))).otherwise(none)
            whole = F.array_join(F.slice(numbers, i + 1, value["n"]), "")
            made = lambda open_, skip, out: F.struct(
                F.struct(open_.alias("open"), skip.alias("skip")).alias("state"), out.alias("out")
            )
            return (
                F.when(i < state["skip"], made(state["open"], state["skip"], none))
                .when(i >= F.size(numbers), made(F.lit(""), state["skip"], closed))
                .when(value.isNotNull(), made(F.lit(""), i + value["n"], F.concat(closed, F.array(part(whole, value["k"])))))
                .when(full, made(text, state["skip"], closed))
                .otherwise(made(F.concat(state["open"], text), state["skip"], none))
            )

        start = F.struct(F.lit("").alias("open"), F.lit(0).alias("skip"))
        # one step behind the last number closes what is open
        return F.flatten(scanned(F.sequence(F.lit(0), F.size(numbers)), start, add, f"array<{PIECE}>"))

    def named(x: Column) -> Column:
        kind = F.when(x["k"] == "open", kind_of(bare(x["s"]))).otherwise(x["k"])
        return F.array(part(lead(x["s"]), none), part(bare(x["s"]), kind))

    def run(numbers: Column) -> Column:
        pieces = let(values(numbers), lambda found: cut(numbers, found))
        return F.flatten(F.transform(pieces, named))

    numbers = F.regexp_extract_all(m, F.lit("[^0-9]*[0-9]+"), F.lit(0))
    return F.when(m.rlike(r"^[0-9+() .-]+$"), let(numbers, run)).otherwise(F.array(part(m, kind_of(m))))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The match under the permutation of its kind."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.char_length(digits)

    at = F.instr(m, "@")
    email = F.concat(permuted_text(F.substring(m, F.lit(1), at - 1), key, "email"), F.substring(m, at, F.char_length(m)))

    bare = F.replace(m, F.lit(" "), F.lit(""))
    account = permuted_text(F.substring(bare, F.lit(5), F.char_length(bare)), key, "iban")
    check = lambda a: F.lpad((98 - mod97(F.concat(F.substring(bare, 1, 2), F.lit("00"), a))).cast("string"), 2, "0")
    iban = refilled(m, let(account, lambda a: F.concat(F.substring(bare, 1, 2), check(a), a)), "[A-Z0-9]")

    # 1800-01-01 to 2199-12-31: one full cycle of the calendar, 146,097 days
    first = F.lit("1800-01-01").cast("date")
    days = F.datediff(day_of(m), first).cast("long")
    other_day = lambda d: feistel(d, 189, 773, key, "date")

    def walk(d: Column, _: Column) -> Column:
        """On to the next day of the cycle, until one that can only be read with
        its month first, as the first one was; two of five steps go on."""
        return F.when(F.dayofmonth(F.date_add(first, d.cast("int"))) > 12, d).otherwise(other_day(d))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), other_day(days), walk)
    new_days = F.when(month_first(m), walked).otherwise(other_day(days))

    def spelt_date(number: Column) -> Column:
        """In the order, with the separators and the padding of the match."""
        day, p = F.date_add(first, number.cast("int")), date_parts(m)
        year, month, of_month = F.date_format(day, "yyyy"), F.date_format(day, "M"), F.date_format(day, "d")
        short = F.exists(p, lambda x: F.char_length(x) == 1)
        two = lambda x: F.when(short, x).otherwise(F.lpad(x, 2, "0"))
        mark = F.regexp_extract(m, "[-/.]", 0)
        return (
            F.when(F.char_length(F.get(p, F.lit(0))) == 4, F.concat(year, mark, two(month), mark, two(of_month)))
            .when(month_first(m), F.concat(two(month), mark, two(of_month), mark, year))
            .otherwise(F.concat(two(of_month), mark, two(month), mark, year))
        )

    date = let(new_days, spelt_date)

    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    word = lambda i: F.get(octets, i) * 256 + F.get(octets, i + 1)
    ip = let(
        feistel(word(0) * 65536 + word(2), 65536, 65536, key, "ip"),
        lambda x: F.concat_ws(".", *[F.shiftright(x, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]),
    )

    # area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999
    area = F.substring(digits, 1, 3).cast("long")
    rank = area - F.when(area > 666, 2).otherwise(1)
    rest = (F.substring(digits, 4, 2).cast("long") - 1) * 9999 + F.substring(digits, 6, 4).cast("long") - 1
    low = F.lit(99 * 9999).cast("long")

    def spelt_social(number: Column) -> Column:
        new_rank, new_rest = F.floor(number / low).cast("long"), F.pmod(number, low)
        return F.concat_ws(
            "-",
            F.lpad((new_rank + F.when(new_rank >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(new_rest / 9999).cast("long") + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(new_rest, F.lit(9999)) + 1).cast("string"), 4, "0"),
        )

    social = let(feistel(rank * low + rest, 898, 99 * 9999, key, "social"), spelt_social)

    inner = F.concat(F.substring(digits, 1, 1), permuted_digits(F.substring(digits, F.lit(2), n - 2), key, "card"))
    checked = lambda x: F.concat(x, F.pmod(10 - luhn_sum(x, 1) % 10, F.lit(10)).cast("string"))
    card = refilled(m, let(inner, checked), "[0-9]")

    # ten digits of the numbering plan: area and exchange start with 2 to 9
    code = F.when((n == 11) & digits.startswith("1"), F.lit("1")).otherwise(F.lit(""))
    ten = F.substring(digits, F.char_length(code) + 1, F.lit(10))
    local = F.substring(ten, 4, 7).cast("long") - 2_000_000
    size = F.lit(8_000_000).cast("long")
    plan = let(
        feistel((F.substring(ten, 1, 3).cast("long") - 200) * size + local, 800, 8_000_000, key, "phone"),
        lambda x: F.concat(
            code,
            (F.floor(x / size).cast("long") + 200).cast("string"),
            (F.pmod(x, size) + 2_000_000).cast("string"),
        ),
    )
    abroad = F.concat(F.substring(digits, 1, 2), permuted_digits(F.substring(digits, F.lit(3), n - 2), key, "abroad"))
    in_plan = (F.char_length(ten) == 10) & ((n == 10) & ~m.startswith("+") | (n == 11) & (code == "1")) & ten.rlike(
        "^[2-9][0-9]{2}[2-9]"
    )
    phone = refilled(m, F.when(in_plan, plan).otherwise(abroad), "[0-9]")

    out = m
    for name, value in (("email", email), ("iban", iban), ("date", date), ("ip", ip), ("social", social), ("card", card), ("phone", phone)):
        out = F.when(kind == name, value).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` with every validated
    value replaced, ``n_replaced`` and ``n_<kind>`` for each kind.

    Values that fail validation (check digit, calendar, ranges) stay as they
    are; numbers beside a value do not hide it. A value keeps its separators, so
    the same number in two spellings gets the same digits. Dates have the year
    first or last, one or two digits for day and month, and, with the year last,
    the day first unless only the month can be; a date goes to one of the same
    spelling. NULL texts stay NULL with zero counts, texts are processed whole in
    time that grows with their length, rows that repeat are each rewritten, an
    empty table gives none, and other columns are not read.
    """
    # every pattern holds a digit or an @, which most texts have not
    matches = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    found = docs.select("doc_id", "text", F.coalesce(matches, F.array().cast("array<string>")).alias("_m"))
    cut = found.withColumn("_p", F.transform("_m", parts_of)).withColumn("_k", F.transform(F.flatten("_p"), lambda x: x["k"]))
    renamed = lambda x: F.when(x["k"].isNotNull(), pseudonym(x["s"], x["k"], key)).otherwise(x["s"])
    new = cut.withColumn("_n", F.transform("_p", lambda p: F.array_join(F.transform(p, renamed), "")))
    gaps = new.withColumn("_g", F.when(F.size("_m") > 0, F.split("text", ANY, -1)))
    whole = F.array_join(F.zip_with("_g", "_n", lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    count = lambda k: F.size(F.filter("_k", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return gaps.select(
        "doc_id",
        F.when(F.size("_m") > 0, whole).otherwise(F.col("text")).alias("text"),
        F.size(F.filter("_k", lambda x: x.isNotNull())).cast("long").alias("n_replaced"),
        *[count(k) for k in KINDS],
    )
