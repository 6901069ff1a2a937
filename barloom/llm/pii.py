"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Entities are found by one pattern, so that a text is cut into parts and entities once.
All distinct entities of the corpus get surrogates from a keyed digest, in the same form:
digits for digits, letters for letters, valid octets, a given name of the same gender and
script. Surrogates that collide with each other or with any real entity are drawn anew,
so distinct entities stay distinct and equal ones equal, in all documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import fresh, kept_table

# What counts as an entity. Each begins with a cheap test, so that most places of a text fail at once.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "secret": r"\b(?=[PpSsTtAa])(?i:password|passwd|pwd|secret|token|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[^\s\"'=:,;\x1e][^\s\"',;\x1e]{5,}",
    "card": r"(?<![\w\-])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){2,3})(?![\w\-])",
    "ssn": r"(?<![\w\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])",
    "phone": r"(?<!\w)(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{2,4}\)[ .\-]?[0-9]{3,4}[ .\-]?[0-9]{3,4}(?!\w)|(?<!\w)\+[0-9](?:[ .\-]?[0-9]){7,13}(?!\w)|(?<![\w\-.])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![\w\-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![\w]|\.[0-9])",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "name": r"(?<!\w)(?:Mrs|Miss|Ms|Mr|Frau|Herr|Señora|Señor|Madame|Monsieur|Г-жа|Г-н)\.? \p{Lu}[\p{L}'\-]+(?: \p{Lu}[\p{L}'\-]+)?",
}
FIRST = {"(?=[+(0-9])": ("card", "ssn", "phone", "ip"), "(?=[A-ZГ])": ("access_key", "iban", "name"), "": ("email", "secret")}
PATTERN = "|".join(f"{test}(?:" + "|".join(f"(?:{KINDS[k]})" for k in kinds) + ")" for test, kinds in FIRST.items())
SECRET_MARK = r"^\w+\s{0,2}[=:]\s{0,2}[\"']?"
FEMALE = r"^(?:Mrs|Miss|Ms|Frau|Señora|Madame|Г-жа)\b"
# Given names and surname syllables by gender and script.
GIVEN = {
    ("latin", "f"): "Ada Bea Cora Dina Edith Flora Greta Hanna Ida Jana Kira Lena Mara Nora Olga Paula".split(),
    ("latin", "m"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Max Nils Otto Paul".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Ева Зоя Инна Кира Лидия Мария Нина Ольга Полина Рада София Таня Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк Никита Олег Павел Роман Тимур Юрий".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga go ka ke la le lo ma mi mo na ne no pa po ra re ro sa se ta ti va vo".split(),
    "cyrillic": "ба бе бо да де до фа фи га го ка ке ла ле ло ма ми мо на не но па по ра ре ро са се та ти ва во".split(),
}
ROUNDS = 12


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(entity: Column) -> Column:
    """The kind whose pattern matches the whole entity; its surroundings no longer count."""
    plain = [F.when(F.regexp_like(entity, F.lit(f"^(?:{p})$")), k) for k, p in KINDS.items()]
    return F.coalesce(*plain, F.lit("secret"))


def identity(kind: Column, entity: Column) -> Column:
    """What two spellings of one entity share: the digits of numbers, lower case of addresses, a secret without its keyword."""
    return F.when(kind.isin("card", "phone", "ssn"), digits_of(entity)).when(kind == "email", F.lower(entity)).when(kind == "secret", F.regexp_replace(entity, SECRET_MARK, "")).otherwise(entity)


def draw(seed: Column, place: Column, size: int) -> Column:
    """A number below size from two hex digits of the seed (128 of them), by place."""
    pair = F.substring(seed, (place % 64 * 2 + 1).cast("int"), F.lit(2))
    return F.pmod(F.conv(pair, 16, 10).try_cast("int") + F.floor(place / 64).cast("int") * 7, F.lit(size))


def drawn_letters(text: Column, seed: Column, skip: int = 0) -> Column:
    """Every digit and ASCII letter of text drawn anew in its class; hex strings stay hex, the first ``skip`` characters stay."""
    hexed = F.regexp_like(text, F.lit("^[0-9a-f]+$"))
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))

    def pick(letters: str, p: Column) -> Column:
        return F.substring(F.lit(letters), draw(seed, p, len(letters)) + 1, F.lit(1))

    def one(p: Column) -> Column:
        c = F.substring(text, p, F.lit(1))
        return (
            F.when(p <= skip, c)
            .when(hexed & F.regexp_like(c, F.lit("[a-f]")), pick("abcdef", p))
            .when(F.regexp_like(c, F.lit("[0-9]")), pick("0123456789", p))
            .when(F.regexp_like(c, F.lit("[a-z]")), pick("abcdefghijklmnopqrstuvwxyz", p))
            .when(F.regexp_like(c, F.lit("[A-Z]")), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", p))
            .otherwise(c)
        )

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(places, one), ""))


def octets(text: Column, seed: Column) -> Column:
    """Four octets with as many digits each as before."""

    def one(part: Column, k: Column) -> Column:
        n = F.length(part)
        return F.when(n == 1, 1 + draw(seed, k, 9)).when(n == 2, 10 + draw(seed, k, 90)).otherwise(100 + draw(seed, k, 100)).cast("string")

    return F.array_join(F.transform(F.split(text, r"\."), one), ".")


def luhn(digits: Column) -> Column:
    """The digits with a last one that makes their Luhn sum whole."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(body), F.lit(1))), lambda p: F.substring(body, p, F.lit(1)))
    values = F.transform(F.reverse(each), lambda d, k: d.try_cast("int") * F.when(k % 2 == 0, 2).otherwise(1))
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def luhn_valid(digits: Column) -> Column:
    return luhn(digits) == digits


def person(text: Column, seed: Column) -> Column:
    """The title, then a given name of its gender and the name's script; a surname where there was one."""
    title = F.regexp_extract(text, r"^(\S+ )", 1)
    female = F.regexp_like(text, F.lit(FEMALE))
    cyrillic = F.regexp_like(F.regexp_extract(text, r" (.*)$", 1), F.lit(r"\p{IsCyrillic}"))
    two = F.regexp_like(text, F.lit(r"^\S+ \S+ \S"))

    def surname(script: str) -> Column:
        parts = [F.element_at(F.array(*map(F.lit, SYLLABLES[script])), draw(seed, F.lit(k), len(SYLLABLES[script])) + 1) for k in range(2, 5)]
        return F.initcap(F.concat(*parts))

    def full(script: str) -> Column:
        def given(g: str) -> Column:
            names = GIVEN[script, g]
            return F.element_at(F.array(*map(F.lit, names)), draw(seed, F.lit(1), len(names)) + 1)

        name = F.when(female, given("f")).otherwise(given("m"))
        return F.when(two, F.concat(name, F.lit(" "), surname(script))).otherwise(surname(script))

    return F.concat(title, F.when(cyrillic, full("cyrillic")).otherwise(full("latin")))


def surrogate(kind: Column, entity: Column, key: str, attempt: int) -> Column:
    """The surrogate of an identity. From half of the rounds on a short tail makes room in small classes."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(attempt)), kind, entity).cast("binary"), 512)
    card = F.when(luhn_valid(entity), luhn(drawn_letters(entity, seed))).otherwise(drawn_letters(entity, seed))
    user, host = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    tail = F.regexp_extract(host, r"(\.[^.]+)$", 1)
    mail = F.concat(drawn_letters(user, seed), F.lit("@"), drawn_letters(F.substring(host, F.lit(1), F.length(host) - F.length(tail)), F.reverse(seed)), tail)
    made = (
        F.when(kind == "email", mail)
        .when(kind == "ip", octets(entity, seed))
        .when(kind == "card", card)
        .when(kind == "name", person(entity, seed))
        .when(kind == "access_key", drawn_letters(entity, seed, 4))
        .when(kind == "iban", drawn_letters(entity, seed, 2))
        .otherwise(drawn_letters(entity, seed))
    )
    return made if attempt < ROUNDS // 2 else F.concat(made, F.substring(digits_of(seed), F.lit(1), F.lit(attempt - ROUNDS // 2 + 1)))


def spelled(kind: Column, entity: Column, made: Column) -> Column:
    """The surrogate in the spelling of this occurrence: the marks between digits, upper case."""
    def place(p: Column) -> Column:
        c = F.substring(entity, p, F.lit(1))
        number = F.length(digits_of(F.substring(entity, F.lit(1), p)))
        return F.when(F.regexp_like(c, F.lit("[0-9]")), F.substring(made, number, F.lit(1))).otherwise(c)

    marked = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), place), "")
    rest = F.substring(made, F.length(digits_of(entity)) + 1, F.length(made))
    shout = (kind == "email") & (entity == F.upper(entity)) & (entity != F.lower(entity))
    return F.when(kind.isin("card", "phone", "ssn"), F.concat(marked, rest)).when(kind == "secret", F.concat(F.regexp_extract(entity, SECRET_MARK, 0), made)).when(shout, F.upper(made)).otherwise(made)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, identity, made) for distinct (kind, identity), all made distinct within a kind and none a real identity.

    A round draws for all that are left; of those that drew the same the least keeps it.
    Raises if some are left after ROUNDS rounds.
    """
    left = kept_table(entities.select("kind", "identity").distinct(), "identities")
    real, done = left.select("kind", F.col("identity").alias("made")), None
    for attempt in range(ROUNDS):
        tried = left.withColumn("made", surrogate(F.col("kind"), F.col("identity"), key, attempt)).join(real, ["kind", "made"], "left_anti")
        if done is not None:
            tried = tried.join(done.select("kind", "made"), ["kind", "made"], "left_anti")
        won = tried.groupBy("kind", "made").agg(F.min("identity").alias("identity")).select("kind", "identity", "made")
        won = kept_table(won, "surrogates")
        done = won if done is None else done.unionByName(won)
        left = kept_table(left.join(won.select("kind", "identity"), ["kind", "identity"], "left_anti"), "left")
        if not left.take(1):
            return done
    raise ValueError("too many distinct entities of one form for distinct surrogates")


def replace_entities(docs: DataFrame, key: str, text: str = "text", counted: str | None = None) -> DataFrame:
    """docs with every entity of the text column replaced by its surrogate; all columns and rows stay.

    Null and empty texts, and texts without entities, come out as they are; only texts
    with entities are shuffled. Equal rows are treated alike. ``counted`` names a further
    column with the number of entities (null text: 0). Surrogates depend on the key, the
    entity, and, where drawn anew, on the other entities of docs.
    """
    names = docs.columns
    listed, mapping = fresh(docs, "entities"), fresh(docs, "surrogates")
    found = docs.withColumn(listed, F.coalesce(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>")))
    number = [F.size(listed).cast("long").alias(counted)] if counted else []
    plain = found.where(F.size(listed) == 0).select(*[f"`{c}`" for c in names], *number)
    marked = found.where(F.size(listed) > 0)

    entity = F.col("entity")
    listing = F.sha2(F.concat_ws("\x1e", F.array_distinct(F.col(listed))).cast("binary"), 256)  # no entity holds 0x1E
    lists = marked.select(listing.alias("list"), F.explode(F.array_distinct(F.col(listed))).alias("entity"))
    ones = kept_table(lists.distinct(), "entities")
    every = ones.select("entity").distinct().withColumn("kind", kind_of(entity)).withColumn("identity", identity(F.col("kind"), entity))
    every = kept_table(every, "kinds")
    made = every.join(surrogates(every, key), ["kind", "identity"]).select("entity", spelled(F.col("kind"), entity, F.col("made")).alias("made"))
    maps = ones.join(made, "entity").groupBy("list").agg(F.map_from_entries(F.collect_list(F.struct("entity", "made"))).alias(mapping))

    joined = marked.join(maps.withColumnRenamed("list", mapping + "_list"), listing == F.col(mapping + "_list"))
    swaps = F.concat(F.transform(F.col(listed), lambda e: F.element_at(F.col(mapping), e)), F.array(F.lit("")))
    done = F.array_join(F.zip_with(F.split(F.col(f"`{text}`"), PATTERN, -1), swaps, lambda p, s: F.concat(p, s)), "")
    return plain.unionByName(joined.select(*[done.alias(c) if c == text else F.col(f"`{c}`") for c in names], *number))
