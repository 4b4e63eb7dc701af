"""Surrogates for personal data, in column expressions only.

Mail addresses, phone numbers, network addresses, card and social security
numbers, access secrets and names of persons are replaced by others of their
kind. A replacement is drawn by a keyed digest of what is replaced, so one
person or number gets one replacement in all documents: spelling is first put
into one form (case of addresses and names, separators of numbers). It keeps the
format: length and separators of numbers, the check digit of cards, country
codes, capitals, the script of a name, and its gender, which a title or first
name shows and a Cyrillic ending must agree with.

First names are exchanged by a keyed cycle over the names of their gender and
script, so two never meet. All other draws are checked over the whole corpus: no
two originals may share a surrogate, and no surrogate may be an original. Where
that happens all but the lowest draw again, until none is left; those few are
the only ones that need a table.

Defined results: a null text stays null, texts without entities are unchanged;
repeated rows are replaced alike; an empty table gives no rows; ``n_replaced``
and ``kinds`` replace input columns of these names, all other columns stay.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import stored

# --- fixed values ------------------------------------------------------------

FIRST_NAMES = {
    ("latin", "m"): (
        "Adam Albert Alexander Antoine Arthur Carlos Charles Christian Daniel"
        " David Diego Edward Fernando Francisco François Friedrich Fritz"
        " George Günther Hans Heinrich Henry Jacques James Javier John Jorge"
        " José Joseph Juan Jürgen Klaus Louis Luis Manuel Matthew Michael"
        " Miguel Nicolas Otto Pablo Patrick Paul Pedro Peter Philippe Pierre"
        " Richard Robert Stefan Thomas Walter William Wolfgang"
    ).split(),
    ("latin", "f"): (
        "Alice Amélie Ana Andrea Angela Anna Barbara Brigitte Camille Carmen"
        " Catherine Charlotte Chloé Christine Claudia Elena Elizabeth Emily"
        " Emma Eva Françoise Greta Hannah Heidi Helen Helga Inés Isabel"
        " Jennifer Jessica Julia Karen Laura Linda Louise Lucía Margaret"
        " María Maria Marie Mary Monika Nathalie Patricia Pilar Rosa Sabine"
        " Sarah Sofía Sophie Susan Ursula Victoria"
    ).split(),
    ("cyrillic", "m"): (
        "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Игорь"
        " Максим Михаил Николай Олег Павел Пётр Сергей Юрий"
    ).split(),
    ("cyrillic", "f"): (
        "Александра Алла Анастасия Анна Вера Галина Екатерина Елена Ирина"
        " Людмила Мария Надежда Наталья Ольга Светлана Татьяна Юлия"
    ).split(),
}
TITLES = (
    "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora"
    " Sr Sra господин госпожа г-н г-жа"
).split()
LETTERS = {
    "latin": ("bdfghklmnprstvw", "aeiou", ("ner", "son", "man", "well", "ler", "ton", "dez", "rand")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("ков", "нов", "лев", "рин", "тин")),
}

# --- detection ---------------------------------------------------------------

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
WORD = r"\p{Lu}[\p{L}'’-]*\p{L}"
_FIRST = "|".join(
    x for names in FIRST_NAMES.values() for n in names for x in (n, n.upper())
)
_TITLE = "|".join(TITLES)
# In the order in which they are tried at a place of a text.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*"
    r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])",
    "ip": rf"(?<![\w.-])(?:{OCTET}\.){{3}}{OCTET}(?![\w-]|\.\d)",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])"
    r"\d{3}[ .-]\d{4}(?![\w-])",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)",
    "secret": r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)|(?<=(?:token|passwd|password|"
    r"secret|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?)[A-Za-z0-9+/_-]{8,}",
    "name": rf"(?<![\p{{L}}\d-])(?=[\p{{Lu}}г])(?:(?:{_TITLE})\.?[ ](?:{WORD})"
    rf"(?:[ ]{WORD}){{0,2}}|(?:{_FIRST})(?![\p{{L}}\d])(?:[ ]{WORD})?)",
}
# Cards as they are commonly written, wherever in a row of numbers they begin.
CARDS = tuple(
    rf"(?<![\w.+-])(?=((?=[3-6]|2[2-7]){written}(?![\w-]|\.\d)))"
    for written in (
        r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}",
        r"\d{4}(?:[ -]\d{4}){3}[ -]\d{1,2}",
        r"\d{4}(?:[ -]\d{4}){3}",
        r"\d{4}[ -]\d{6}[ -]\d{4,5}",
    )
)
# What a text with a card must hold.
CARD_HINT = r"(?<![\w.+-])\d(?:[ -]?\d){12}"


def entity_pattern(card: str = "") -> str:
    """The pattern of all kinds, with this one for cards or without them."""
    tried = PATTERNS | {"card": card}
    return "|".join(f"(?:{p})" for p in tried.values() if p)


# What a text must hold for a look at it to be worth its while.
# Every pattern above needs one of these.
HINT = (
    r"[0-9@]|AKIA|(?:token|passwd|password|secret|api_?key)[ ]{0,2}[=:]"
    rf"|(?<!\p{{L}})(?=[\p{{Lu}}г])(?:{_TITLE}|{_FIRST})(?!\p{{L}})"
)


def luhn(digits: Column) -> Column:
    """The check sum of a string of digits, right to left."""
    values = F.transform(
        F.split(F.reverse(digits), ""), lambda d: d.cast("int")
    )
    weighed = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d)


def digits_of(entity: Column) -> Column:
    return F.regexp_replace(entity, r"\D", "")


def cards_of(text: Column) -> Column:
    """The numbers of a text whose check sum is that of a card. A pattern can't
    see the sum, so numbers are tried in all common groupings, and as a whole if
    no other number is in them."""
    other = "|".join(PATTERNS[kind] for kind in ("ssn", "phone"))
    whole = F.filter(
        F.regexp_extract_all(text, F.lit(PATTERNS["card"]), F.lit(0)),
        lambda c: ~c.rlike(other),
    )
    written = (F.regexp_extract_all(text, F.lit(c), F.lit(1)) for c in CARDS)
    none = F.array().cast("array<string>")
    return F.when(
        text.rlike(CARD_HINT),
        F.filter(
            F.array_distinct(F.concat(whole, *written)),
            lambda c: luhn(digits_of(c)) % 10 == 0,
        ),
    ).otherwise(none)


def by_pattern(cards: Column, use) -> Column:
    """``use`` of the pattern for a text with these cards. The usual text has
    none, and its pattern is the same for all rows."""
    before, behind = entity_pattern("\0").split("\0")
    own = F.concat(
        F.lit(before + r"(?<![\w.+-])(?:"),
        F.array_join(cards, "|"),
        F.lit(r")(?![\w-]|\.\d)" + behind),
    )
    return F.when(F.size(cards) == 0, use(F.lit(entity_pattern()))).otherwise(
        use(own)
    )


def kind_of(entity: Column) -> Column:
    """Kind of a detected string; null for a number that is no card."""
    is_a = lambda kind: entity.rlike(f"^(?:{PATTERNS[kind]})$")
    return (
        F.when(entity.contains("@"), "email")
        .when(is_a("ip"), "ip")
        .when(is_a("ssn"), "ssn")
        .when(is_a("phone"), "phone")
        .when(
            is_a("card"),
            F.when(luhn(digits_of(entity)) % 10 == 0, "card"),
        )
        .when(is_a("name"), "name")
        .otherwise("secret")
    )


# --- surrogates --------------------------------------------------------------


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out, and written into the plan, once
    however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


UNIT = "struct<kind: string, plain: string>"


def plain_of(kind: Column, entity: Column) -> Column:
    """The one form of all spellings of an entity."""
    feminine = r"(?<=[оеи][вн])а$"
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "phone", F.right(digits_of(entity), F.lit(10)))
        .when(kind.isin("card", "ssn"), digits_of(entity))
        .when(
            kind == "surname",
            F.regexp_replace(F.lower(entity), feminine, ""),
        )
        .otherwise(entity)
    )


def unit(kind: Column, entity: Column) -> Column:
    return F.struct(kind.alias("kind"), plain_of(kind, entity).alias("plain"))


def keyed_digest(key: str, *parts: Column) -> Column:
    inner = F.sha2(F.concat_ws("\0", F.lit(key), *parts), 256)
    return F.sha2(F.concat(F.lit(key), inner), 256)


class Draw:
    """Draws for one unit: numbers that follow from the keyed digest of the
    unit and the attempt only."""

    def __init__(self, digest: Column):
        self.digest = digest

    def below(self, n: int | Column, *which) -> Column:
        at = [x if isinstance(x, Column) else F.lit(x) for x in which]
        n = n if isinstance(n, Column) else F.lit(n)
        return F.pmod(F.xxhash64(self.digest, *at), n.cast("long")).cast("int")

    def letter(self, letters: str, *which) -> Column:
        return F.substring(
            F.lit(letters), self.below(len(letters), *which) + 1, F.lit(1)
        )


LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"


def like_chars(draw: Draw, text: Column, hexadecimal: Column, salt: str) -> Column:
    """Each letter and digit exchanged for one of its sort. A text without
    either (``________``) has every character but white space exchanged for a
    letter: kept as it is, it would be drawn as itself at every attempt."""
    plain = ~text.rlike("[A-Za-z0-9]")

    def one(c: Column, i: Column) -> Column:
        lower = F.when(
            hexadecimal, draw.letter(LOWER[:6], F.lit(salt), i)
        ).otherwise(draw.letter(LOWER, F.lit(salt), i))
        return (
            F.when(c.rlike("[a-z]"), lower)
            .when(c.rlike("[A-Z]"), F.upper(lower))
            .when(c.rlike("[0-9]"), draw.letter(DIGITS, F.lit(salt), i))
            .when(plain & ~c.rlike("\\s"), lower)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def like_digits(text: Column, digit) -> Column:
    """Digits exchanged by ``digit(place from the right, old)``."""
    chars = F.split(text, "")

    def one(c: Column, i: Column) -> Column:
        behind = F.length(
            digits_of(F.substring(text, i + 2, F.length(text)))
        )
        return F.when(c.rlike("[0-9]"), digit(behind, c)).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


def surrogate(
    key: str, kind: Column, entity: Column, attempt: Column
) -> Column:
    """The surrogate of an entity that is one unit."""
    named = F.struct(
        kind.alias("kind"),
        entity.alias("entity"),
        plain_of(kind, entity).alias("plain"),
    )
    return let(
        named,
        lambda u: let(
            keyed_digest(key, u["kind"], u["plain"], attempt.cast("string")),
            lambda digest: _drawn(
                key, u["kind"], u["entity"], u["plain"], Draw(digest)
            ),
        ),
    )


def _drawn(
    key: str, kind: Column, entity: Column, plain: Column, draw: Draw
) -> Column:
    no = F.lit(False)

    # A domain is drawn by itself, so that colleagues stay colleagues.
    domain = F.lower(F.substring_index(entity, "@", -1))
    host = F.substring(
        domain,
        F.lit(1),
        F.length(domain) - F.length(F.substring_index(domain, ".", -1)) - 1,
    )
    email = F.concat(
        like_chars(draw, F.substring_index(entity, "@", 1), no, "local"),
        F.lit("@"),
        let(
            keyed_digest(key, F.lit("domain"), domain),
            lambda digest: like_chars(Draw(digest), host, no, "host"),
        ),
        F.lit(".example"),
    )

    # The first number is from 11 to 99: a public address.
    ip = F.concat_ws(
        ".",
        (draw.below(89, 0) + 11).cast("string"),
        *((draw.below(254, i) + 1).cast("string") for i in (1, 2, 3)),
    )

    # Ten digits from the right are drawn; what is before them is the country.
    # The first digits of area and exchange are 2 to 9.
    def phone_digit(behind: Column, old: Column) -> Column:
        return (
            F.when(behind > 9, old)
            .when(behind.isin(9, 6), draw.letter("23456789", behind))
            .otherwise(draw.letter(DIGITS, behind))
        )

    # The first digit, which names the issuer, stays; the last is the check
    # digit of the others.
    size = F.length(plain)

    def card_digit(behind: Column, old: Column) -> Column:
        return F.when(behind == size - 1, old).otherwise(
            draw.letter(DIGITS, behind)
        )

    open_card = F.concat(
        F.substring(
            like_digits(plain, card_digit), F.lit(1), size - 1
        ),
        F.lit("0"),
    )
    check = F.pmod(-luhn(open_card), F.lit(10)).cast("string")
    card = like_digits(
        entity,
        lambda behind, old: F.when(behind == 0, check).otherwise(
            card_digit(behind, old)
        ),
    )
    ssn = like_digits(
        entity,
        lambda behind, old: F.when(
            behind == 8, draw.letter("1234578", behind)
        ).otherwise(draw.letter("123456789", behind)),
    )

    prefix = F.when(entity.rlike("^AKIA[A-Z0-9]{16}$"), 4).otherwise(0)
    secret = F.concat(
        F.substring(entity, F.lit(1), prefix),
        like_chars(
            draw,
            F.substring(entity, prefix + 1, F.length(entity)),
            entity.rlike("^[0-9a-f]+$"),
            "secret",
        ),
    )

    def surname(script: str) -> Column:
        hard, soft, ends = LETTERS[script]
        last = F.element_at(
            F.array(*map(F.lit, ends)), draw.below(len(ends), "end") + 1
        )
        return F.concat(
            *(
                draw.letter(letters, place, salt)
                for place in range(2)
                for letters, salt in ((hard, "hard"), (soft, "soft"))
            ),
            last,
        )

    cyrillic = entity.rlike(r"\p{IsCyrillic}")
    made = F.initcap(
        F.when(
            cyrillic,
            F.concat(
                surname("cyrillic"),
                F.when(F.lower(entity) != plain, "а").otherwise(""),
            ),
        ).otherwise(surname("latin"))
    )
    made = F.when(
        (F.upper(entity) == entity) & (F.length(entity) > 1), F.upper(made)
    ).otherwise(made)
    # Of a person's plain form, the surrogate is its plain form again.
    made = F.when(F.lower(entity) == entity, F.lower(made)).otherwise(made)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "phone", like_digits(entity, phone_digit))
        .when(kind == "card", card)
        .when(kind == "ssn", ssn)
        .when(kind == "surname", made)
        .otherwise(secret)
    )


def first_name_cycle(key: str) -> dict[str, str]:
    """Each first name's surrogate: the next in a keyed order of its list."""
    found = {}
    for names in FIRST_NAMES.values():
        order = sorted(
            names,
            key=lambda n: hashlib.sha256(f"{key}\0{n}".encode()).digest(),
        )
        for name, other in zip(order, order[1:] + order[:1]):
            found[name] = other
            found[name.upper()] = other.upper()
    return found


# --- corpus ------------------------------------------------------------------


GIVEN = rf"^(?:(?:{_TITLE})\.?|{_FIRST})$"


def _surnames(entity: Column) -> Column:
    """The words of a name that are neither title nor first name."""
    return F.filter(F.split(entity, " "), lambda t: ~t.rlike(GIVEN))


def _units(entity: Column) -> Column:
    """The units of an entity that are drawn: the surnames of a name, nothing
    of a number that is no card, and else the entity itself."""
    return let(
        kind_of(entity),
        lambda kind: F.when(
            kind == "name",
            F.transform(
                _surnames(entity), lambda t: unit(F.lit("surname"), t)
            ),
        )
        .when(kind.isNull(), F.array().cast(f"array<{UNIT}>"))
        .otherwise(F.array(unit(kind, entity))),
    )


def redrawn(units: DataFrame, key: str) -> DataFrame:
    """Units (``kind``, ``plain``) whose first draw can't stand, with the
    ``attempt`` that can. ``units`` has each unit once."""
    draw = lambda df: df.withColumn(
        "drawn",
        plain_of(
            F.col("kind"),
            surrogate(key, F.col("kind"), F.col("plain"), F.col("attempt")),
        ),
    )
    originals = units.select("kind", F.col("plain").alias("drawn"))
    pending = stored(draw(units.withColumn("attempt", F.lit(0))), "drawn")
    settled = None
    rounds = []
    while True:
        lowest = pending.groupBy("kind", "drawn").agg(F.min("plain").alias("low"))
        bad = lowest.join(originals, ["kind", "drawn"], "left_semi").select(
            "kind", "drawn", F.lit(True).alias("bad")
        )
        if settled is not None:
            bad = bad.union(
                lowest.join(settled, ["kind", "drawn"], "left_semi").select(
                    "kind", "drawn", F.lit(True)
                )
            ).distinct()
        judged = stored(
            pending.join(lowest, ["kind", "drawn"])
            .join(bad, ["kind", "drawn"], "left")
            .withColumn(
                "stands", F.col("bad").isNull() & (F.col("plain") == F.col("low"))
            )
            .select("kind", "plain", "attempt", "drawn", "stands"),
            "judged",
        )
        stands = judged.where("stands").select("kind", "plain", "attempt", "drawn")
        rounds.append(stands.where("attempt > 0").drop("drawn"))
        again = judged.where("NOT stands")
        if again.isEmpty():
            return reduce(DataFrame.union, rounds)
        standing = stands.select("kind", "drawn")
        settled = standing if settled is None else settled.union(standing)
        pending = stored(
            draw(
                again.select(
                    "kind", "plain", (F.col("attempt") + 1).alias("attempt")
                )
            ),
            "drawn",
        )


ADDED = ("n_replaced", "kinds")
# Texts with a redrawn unit that may be sent to all tasks.
BROADCAST_TEXTS = 20_000


def replace_entities(
    docs: DataFrame, key: str, prefix: str = ""
) -> DataFrame:
    """``docs`` with surrogates in ``text``, the number of entities replaced
    and their kinds. ``prefix`` goes in front of the names of these two."""
    made = [prefix + c for c in ADDED]
    cycle = first_name_cycle(key)
    first = F.create_map(*(F.lit(x) for pair in cycle.items() for x in pair))
    text = F.col("text")
    found = F.when(
        text.rlike(HINT),
        by_pattern(
            F.col("_cards"), lambda p: F.regexp_extract_all(text, p, F.lit(0))
        ),
    ).otherwise(F.array().cast("array<string>"))

    entities = docs.select("text", cards_of(text).alias("_cards")).select(
        F.explode(found).alias("entity")
    )
    units = (
        entities.distinct()
        .select(F.inline(_units(F.col("entity"))))
        .distinct()
    )
    again = stored(redrawn(stored(units, "units"), key), "redrawn")

    plain = [f"`{c}`" for c in docs.columns if c not in made]
    rows = docs.select(*plain)
    redraws = F.create_map().cast("map<string, int>")
    if not again.isEmpty():
        # Texts with such a unit, by digest, and the attempts for its units.
        named = again.select(
            F.concat_ws("\0", "kind", "plain").alias("_unit"), "attempt"
        )
        concerned = stored(
            docs.where(text.rlike(HINT))
            .select("text", cards_of(text).alias("_cards"))
            .select(
                F.sha2(text, 256).alias("_digest"), F.explode(found).alias("e")
            )
            .select("_digest", F.inline(_units(F.col("e"))))
            .select("_digest", F.concat_ws("\0", "kind", "plain").alias("_unit"))
            .distinct()
            .join(named, "_unit")
            .groupBy("_digest")
            .agg(
                F.map_from_entries(
                    F.collect_list(F.struct("_unit", "attempt"))
                ).alias("_redraws")
            ),
            "concerned",
        )
        if concerned.count() <= BROADCAST_TEXTS:
            concerned = F.broadcast(concerned)
        rows = rows.withColumn("_digest", F.sha2(text, 256)).join(
            concerned, "_digest", "left"
        )
        redraws = F.coalesce("_redraws", redraws)

    def attempt_of(kind: Column, entity: Column) -> Column:
        name = F.concat_ws("\0", kind, plain_of(kind, entity))
        return F.coalesce(redraws[name], F.lit(0))

    def drawn(kind: Column, entity: Column) -> Column:
        return surrogate(key, kind, entity, attempt_of(kind, entity))

    def replaced(e: Column) -> Column:
        # A name word by word, anything else as a whole.
        named = e["kind"] == "name"
        words = F.when(named, F.split(e["entity"], " ")).otherwise(
            F.array(e["entity"])
        )
        sort = F.when(named, "surname").otherwise(e["kind"])
        made = F.transform(
            words,
            lambda w: F.coalesce(
                F.when(named, first[w]),
                F.when(named & w.rlike(GIVEN) | sort.isNull(), w),
                drawn(sort, w),
            ),
        )
        return F.array_join(made, " ")

    rows = rows.withColumn("_cards", cards_of(text)).withColumn(
        "_found",
        F.transform(
            found,
            lambda e: F.struct(e.alias("entity"), kind_of(e).alias("kind")),
        ),
    )
    some = F.size("_found") > 0
    kinds = F.filter("_found.kind", lambda k: k.isNotNull())
    joined = F.array_join(
        F.zip_with(
            by_pattern(F.col("_cards"), lambda p: F.split(text, p, -1)),
            F.transform("_found", replaced),
            lambda piece, made: F.concat(piece, F.coalesce(made, F.lit(""))),
        ),
        "",
    )
    # Surnames that stand alone elsewhere in the text belong to the same person.
    surnames = F.array_distinct(
        F.flatten(
            F.transform(
                F.filter("_found", lambda e: e["kind"] == "name"),
                lambda e: F.filter(
                    _surnames(e["entity"]), lambda t: F.length(t) > 2
                ),
            )
        )
    )
    rows = rows.withColumn("_surnames", surnames).withColumn(
        "_made", F.when(some, joined).otherwise(text)
    )
    joined = F.when(
        F.size("_surnames") > 0,
        F.aggregate(
            "_surnames",
            F.col("_made"),
            lambda made, name: F.regexp_replace(
                made,
                F.concat(
                    F.lit(r"(?<![\p{L}\d@.-])\Q"), name, F.lit(r"\E(?![\p{L}\d])")
                ),
                drawn(F.lit("surname"), name),
            ),
        ),
    ).otherwise(F.col("_made"))
    return rows.select(
        *(
            joined.alias("text")
            if c == "`text`"
            else F.col(c)
            for c in plain
        ),
        F.when(some, F.size(kinds)).otherwise(0).cast("long").alias(made[0]),
        F.when(some, F.array_sort(F.array_distinct(kinds)))
        .otherwise(F.array().cast("array<string>"))
        .alias(made[1]),
    )


def without_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_chars``, where there is
    such a column, set to the new length of a changed text."""
    found = replace_entities(docs, key, prefix="_")
    return found.select(
        *(
            F.when(F.col("_n_replaced") > 0, F.length("text"))
            .otherwise(F.col("n_chars"))
            .cast(docs.schema["n_chars"].dataType)
            .alias("n_chars")
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        )
    )
