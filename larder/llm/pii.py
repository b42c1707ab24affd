"""Personal data replaced by keyed surrogates, in Spark expressions only.

One pattern finds e-mail and IP addresses, card and account numbers, social security numbers, phone
numbers and persons after an honorific. An entity is its kind and canonical form (digits of a
number, lower case of an address or name), so other spellings of one entity are the same one.
Its surrogate comes from ``sha256(key, kind, canonical, attempt)``: digits for digits with the
original's separators, leading digits of phone numbers (country and area) and of cards kept; letters
of the same script; first names of the honorific's gender. The same entity has the same surrogate in
every document. Surrogates that two entities share, or that equal an original entity, are drawn
again with the next attempt for all but the smallest, until none is left, so distinct entities stay
distinct.

Numbers with the same kept digits and length share one space. Where entities fill over a ``CROWDED``-th of theirs,
draws would meet each other too often (or for ever), so a keyed permutation of the whole space takes their
place: distinct by construction, in one step, and never the number itself, but a surrogate there may
be another entity's original.

Texts without entities are not shuffled. Others meet their surrogates by ``(doc_id, hash of text)``.

Defined cases: null texts stay null and empty texts empty; repeated rows are changed alike; null ids
are kept; extra columns are kept; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

# Honorifics by gender, and first names that replace others.
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Señora", "Sra"]
MALE_NAMES = ["Adam", "Bruno", "David", "Felix", "Hugo", "Ivan", "Jonas", "Leon", "Marco", "Nico", "Oscar", "Paul"]
FEMALE_NAMES = ["Alma", "Clara", "Diana", "Elena", "Flora", "Hanna", "Irene", "Julia", "Laura", "Maria", "Nora", "Vera"]
LETTERS = {"latin": "abdefgiklmnoprst", "cyrillic": "абвгдеиклмнопрст", "greek": "αβγδεικλμνοπρστ" + "υ"}

HONORIFIC = rf"(?:{'|'.join(sorted(MALE + FEMALE, key=len, reverse=True))})"
PERSON = rf"(?<![\p{{L}}]){HONORIFIC}\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])"
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)"
    r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
)
ENTITY = "|".join([EMAIL, IBAN, CARD, IP, SSN, PHONE, PERSON])
# Every entity has an at sign, a digit, or an honorific before a capital.
CAUSE = rf"[@0-9]|{HONORIFIC}\.? \p{{Lu}}"


def kind_of(value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(value.rlike(rf"^{HONORIFIC}\b"), "person")
        .when(value.rlike(r"^[A-Z]{2}"), "account")
        .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social")
        .when((digits >= 13) & ~value.rlike(r"[+(]"), "card")
        .otherwise("phone")
    )


def canonical_of(kind: Column, value: Column) -> Column:
    bare_name = F.regexp_replace(value, rf"^{HONORIFIC}\.? ", "")
    return (
        F.when(kind.isin("card", "social", "phone"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "account", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind == "person", F.lower(bare_name))
        .otherwise(F.lower(value))
    )


def gender_of(value: Column) -> Column:
    return F.when(value.rlike(rf"^(?:{'|'.join(FEMALE)})\b"), "f").otherwise("m")


def digits_from(code: Column) -> Column:
    """27 decimal digits of a hexadecimal code."""

    def nine(at: int) -> Column:
        number = F.conv(F.substring(code, at, 15), 16, 10).cast("bigint")
        return F.lpad((number % 1_000_000_000).cast("string"), 9, "0")

    return F.concat(nine(1), nine(16), nine(31))


def letters_from(code: Column, script: Column) -> Column:
    out = F.translate(code, "0123456789abcdef", LETTERS["latin"])
    for name in ("cyrillic", "greek"):
        out = F.when(script == name, F.translate(code, "0123456789abcdef", LETTERS[name])).otherwise(out)
    return out


def script_of(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def surrogate(key: str, kind: Column, canonical: Column, gender: Column, attempt: Column) -> Column:
    """The canonical form of the entity that takes another's place."""
    code = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string")), 256)
    digits, size, letters = digits_from(code), F.length(canonical), letters_from(code, script_of(canonical))

    def keep(first: Column) -> Column:
        return F.concat(F.substr(canonical, F.lit(1), first), F.substr(digits, F.lit(1), size - first))

    def octet(at: int) -> Column:
        return (F.conv(F.substring(code, at, 4), 16, 10).cast("int") % 254 + 1).cast("string")

    def name(names: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(n.lower()) for n in names]), F.conv(F.substring(code, 61, 4), 16, 10).cast("int") % len(names) + 1)

    first_name = F.when(gender == "f", name(FEMALE_NAMES)).otherwise(name(MALE_NAMES))
    last_name = F.substring(letters, 1, 9)
    two = F.contains(canonical, F.lit(" ")) & (script_of(canonical) == "latin")
    # Country and area stay; at least seven digits of a phone number change.
    prefix = F.greatest(F.lit(1), size - 7)
    return (
        F.when(kind == "email", F.concat(F.substring(letters, 1, 12), F.lit("@mail.example.org")))
        .when(kind == "ip", F.concat_ws(".", octet(1), octet(5), octet(9), octet(13)))
        .when(kind == "person", F.when(two, F.concat_ws(" ", first_name, last_name)).otherwise(last_name))
        .when(kind == "account", F.concat(F.substring(canonical, 1, 2), F.substr(digits, F.lit(1), F.least(size - 2, F.lit(27))), F.substr(digits, F.lit(1), F.greatest(size - 29, F.lit(0)))))
        .when(kind == "phone", keep(prefix))
        .when(kind == "card", keep(F.lit(1)))
        .otherwise(keep(F.lit(0)))
    )


# Entities times this above the numbers there are: the space is crowded.
CROWDED = 4
TURNS = 8


def kept_digits(kind: Column, canonical: Column) -> Column:
    """How many leading digits of a number its surrogate keeps; null for entities that are not numbers."""
    size = F.length(canonical)
    return (
        F.when(kind == "phone", F.greatest(F.lit(1), size - 7)).when(kind == "card", 1).when(kind == "social", 0)
    )


def permuted(key: str, kind: Column, canonical: Column, kept: Column) -> Column:
    """Another number with the same leading digits, by a keyed permutation without fixed points.

    A Feistel network over the two halves of the changed digits permutes them; one step on in its order, and
    back, is a permutation that leaves nothing where it was.
    """
    size = F.length(canonical)
    changed, prefix = size - kept, F.substr(canonical, F.lit(1), kept)
    high, low = (F.pow(F.lit(10), d).cast("bigint") for d in (F.floor(changed / 2), changed - F.floor(changed / 2)))
    number = F.substr(canonical, kept + 1, changed).cast("bigint")

    def mixed(turn: Column, half: Column) -> Column:
        parts = [F.lit(key), kind, prefix, size.cast("string"), turn.cast("string"), half.cast("string")]
        return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 14), 16, 10).cast("bigint")

    def turned(sign: int):
        def turn(halves: Column, i: Column) -> Column:
            upper = i % 2 == 0
            a = F.when(upper, F.pmod(halves["a"] + sign * mixed(i, halves["b"]), high)).otherwise(halves["a"])
            b = F.when(upper, halves["b"]).otherwise(F.pmod(halves["b"] + sign * mixed(i, halves["a"]), low))
            return F.struct(a.alias("a"), b.alias("b"))

        return turn

    def halves_of(value: Column) -> Column:
        return F.struct(F.floor(value / low).cast("bigint").alias("a"), (value % low).alias("b"))

    there = F.aggregate(F.sequence(F.lit(0), F.lit(TURNS - 1)), halves_of(number), turned(1), lambda h: h["a"] * low + h["b"])
    back = F.aggregate(
        F.sequence(F.lit(TURNS - 1), F.lit(0)), halves_of((there + 1) % (high * low)), turned(-1), lambda h: h["a"] * low + h["b"]
    )
    return F.concat(prefix, F.lpad(back.cast("string"), changed, "0"))


def in_crowds(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, new`` of the entities whose space is crowded."""
    kept = kept_digits(F.col("kind"), F.col("canonical"))
    numbers = entities.withColumn("kept", kept).where("kept is not null and length(canonical) - kept between 1 and 15")
    numbers = numbers.withColumns({"size": F.length("canonical"), "prefix": F.expr("substr(canonical, 1, kept)")})
    space = ["kind", "size", "prefix"]
    crowds = numbers.groupBy(*space).agg(F.count("*").alias("n"), F.first("kept").alias("k"))
    crowds = crowds.where(F.col("n") * CROWDED > F.pow(F.lit(10), F.col("size") - F.col("k"))).select(*space)
    new = permuted(key, F.col("kind"), F.col("canonical"), F.col("kept"))
    return numbers.join(crowds, space).select("kind", "canonical", new.alias("new"))


def shown(kind: Column, value: Column, new: Column) -> Column:
    """A surrogate in the original's format."""

    def place(i: Column) -> Column:
        letter = F.substr(value, i, F.lit(1))
        seen = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), r"[ .()+-]", ""))
        return F.when(letter.rlike(r"[ .()+-]"), letter).otherwise(F.substr(new, seen, F.lit(1)))

    numbered = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), place), "")
    title = F.regexp_extract(value, rf"^({HONORIFIC}\.? )", 1)
    return (
        F.when(kind.isin("email", "ip"), new).when(kind == "person", F.concat(title, F.initcap(new))).otherwise(numbered)
    )


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """``value, replacement`` for each distinct ``value``; distinct entities get distinct surrogates."""
    kind = kind_of(F.col("value"))
    named = values.select("value", kind.alias("kind"), gender_of(F.col("value")).alias("gender"))
    named = written(named.withColumn("canonical", canonical_of(F.col("kind"), F.col("value"))), "values")
    entities = named.groupBy("kind", "canonical").agg(F.min("gender").alias("gender"))
    own = written(entities, "entities")
    columns = ["kind", "canonical", "gender"]
    settled, attempt = written(in_crowds(own, key), "surrogates"), 0
    open_ = own.join(settled, ["kind", "canonical"], "left_anti").select(*columns)
    while not open_.isEmpty():
        drawn = open_.withColumn(
            "new", surrogate(key, F.col("kind"), F.col("canonical"), F.col("gender"), F.lit(attempt))
        )
        # The smallest entity of those that drew one surrogate keeps it, unless it was given before
        # or is an original itself.
        winners = drawn.groupBy("kind", "new").agg(F.min("canonical").alias("canonical"))
        originals = own.select("kind", F.col("canonical").alias("new"))
        winners = winners.join(originals, ["kind", "new"], "left_anti")
        winners = winners.join(settled.select("kind", "new"), ["kind", "new"], "left_anti")
        now = written(winners.select("kind", "canonical", "new"), "surrogates")
        settled = settled.unionByName(now)
        open_ = written(open_.join(now, ["kind", "canonical"], "left_anti").select(*columns), "open-entities")
        attempt += 1
    found = named.join(settled, ["kind", "canonical"])
    return found.select("value", shown(F.col("kind"), F.col("value"), F.col("new")).alias("replacement"))


def anonymized(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with entities in ``text`` replaced; ``n_chars`` follows; plus ``n_entities``."""
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    cause = F.col("text").rlike(CAUSE)
    # What is found in a text is also what split() cuts out of it.
    with_cause = rows.where(cause).withColumn("found", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    keyed = with_cause.select(
        F.col("row.doc_id").alias("id"), F.xxhash64("text").alias("code"), F.sha2("text", 256).alias("digest"), "found"
    )
    uses = written(keyed.where(F.size("found") > 0).distinct(), "entity-uses")
    places = uses.select("id", "code", "digest", F.posexplode("found").alias("place", "value"))
    mapped = surrogates(places.select("value").distinct(), key)
    lists = places.join(mapped, "value").groupBy("id", "code", "digest").agg(
        F.sort_array(F.collect_list(F.struct("place", "replacement"))).alias("list")
    )
    lists = written(lists.select("id", "code", "digest", F.col("list.replacement").alias("list")), "replacements")

    hit = rows.where(cause & F.col("text").rlike(ENTITY))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("code")) & (F.sha2("text", 256) == F.col("digest"))
    met = hit.join(lists, same).select("row", "list", F.split("text", ENTITY, -1).alias("parts"))
    woven = F.transform("list", lambda new, i: F.concat(F.get("parts", i), new))
    changed = met.select(
        "row",
        F.concat(F.array_join(woven, ""), F.element_at("parts", -1)).alias("new"),
        F.size("list").cast("bigint").alias("n"),
    )
    same_text = rows.where(~(cause & F.col("text").rlike(ENTITY))).select(
        "row", F.col("row.text").cast("string").alias("new"), F.lit(0).cast("bigint").alias("n")
    )
    every = same_text.unionByName(changed.select("row", "new", "n"))
    columns = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name.lower() == "text":
            column = F.col("new")
        elif name.lower() == "n_chars":
            column = F.when(F.col("n") > 0, F.length("new").cast(docs.schema[name].dataType)).otherwise(column)
        if name.lower() != "n_entities":
            columns.append(column.alias(name))
    return every.select(*columns, F.col("n").alias("n_entities"))
