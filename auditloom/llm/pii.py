"""PII: surrogates that keep type, gender, script and format (DataFrame operations only).

One pattern finds the entities of a text: e-mail addresses, IPv4 and IPv6 addresses, telephone numbers,
payment card and account numbers, access keys, secret tokens, values after a password label, and names
after an honorific or beginning with a common given name. The words of a name found so are found in the
same text without it, too. A text is split at its entities and put together again with surrogates.

A surrogate belongs to a unit: the entity, of a labelled password the value, of a name each word with
its gender. The gender of a name's word is that of its honorific or given name; a mention that tells none
takes the one that the text tells elsewhere, if only one. So "Dr. Anna Schmidt", "Frau Schmidt" and
"Schmidt's" keep one surname, and equal units have one surrogate in any document (coreference).

Surrogates come from sha2 over key, type, unit and attempt. Digits become digits and letters letters of
the same case and script, other signs stay; IPv4 addresses stay below 256 in each part, card numbers keep
their length and first digit and end in a valid check digit, account numbers keep their country and get
valid check digits, access keys keep their prefix, e-mail addresses get a name of the same shape under
the reserved domain example.org, name words come from a list of the gender and the script. Distinct units
get distinct surrogates that are no unit of the input: a surrogate that two units share, or that occurs
among the units, is drawn anew for all but the first until none is left. After some attempts a surrogate
grows by a sign an attempt, so that even a type with too few forms comes to an end.

The key is the caller's secret: who holds it can tell which surrogate a guessed entity has.

Defined results: null and empty texts come back as they are, with no entity; a document keeps its row
whatever it holds, repeated rows each; texts are taken whole; other columns are left alone, but for two
named ``n_entities`` and ``entity_types``, which the operator's own replace; an empty table gives no row.
The same key and units give the same surrogates, but for those drawn anew.
"""

from __future__ import annotations

import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm.common import dropped, narrowed, saved, widened

#: The session setting that holds the key of the queries.
KEY_SETTING = "spark.auditloom.pii.key"
#: Attempts after which a surrogate grows.
PATIENCE = 8

#: Honorifics by gender, names by gender and script to draw from, and more given names that begin a name.
HONORIFICS = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Sra", "Srta", "Г-жа"), "m": ("Mr", "Herr", "Sr", "Monsieur", "Г-н"), "n": ("Dr", "Prof")}
NAMES = {
    "f": ("Anna", "Clara", "Elena", "Hanna", "Irene", "Julia", "Laura", "Maria", "Nina", "Paula", "Rosa", "Sofia", "Teresa", "Vera"),
    "m": ("Adam", "Bruno", "Carlos", "David", "Erik", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Simon", "Viktor"),
    "n": ("Alex", "Andrea", "Chris", "Dominique", "Jean", "Kim", "Luca", "Noel", "Robin", "Sascha", "Toni", "Val"),
    "cyrillic_f": ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"),
    "cyrillic_m": ("Антон", "Борис", "Виктор", "Иван", "Михаил", "Олег", "Павел", "Сергей"),
    "cyrillic_n": ("Саша", "Женя", "Валя", "Шура"),
}
MORE = {
    "f": ("Alice", "Barbara", "Carmen", "Catherine", "Elizabeth", "Emily", "Emma", "Isabel", "Jennifer", "Jessica", "Karen", "Linda", "Lisa", "Margaret", "Marie", "Mary", "Patricia", "Sarah", "Susan", "Ursula"),
    "m": ("Charles", "Daniel", "George", "Hans", "Henry", "James", "John", "Joseph", "Juan", "Karl", "Klaus", "Luis", "Michael", "Peter", "Pierre", "Richard", "Robert", "Stefan", "Thomas", "William"),
}
GIVEN = {g: tuple(n for k, v in NAMES.items() if k.endswith(g) for n in v) + MORE[g] for g in ("f", "m")}

_TITLES = "|".join(t for k in ("f", "m", "n") for t in sorted(HONORIFICS[k], key=len, reverse=True))
_GIVEN = "|".join(n for g in ("f", "m") for n in sorted(GIVEN[g], key=len, reverse=True))
_WORD = r"\p{Lu}\p{L}*(?:'\p{Lu}\p{L}+|-\p{L}+)*"
_LABEL = r"(?i:\b(?:password|passwd|pwd|api_?key))[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_PREFIX = r"AKIA|ASIA|gh[pousr]_|sk-"
_TITLED = rf"(?:{_TITLES})\.? {_WORD}(?: {_WORD})?"
#: In order: the first type whose pattern matches where an entity begins is its type.
PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[A-Za-z0-9\p{L}][A-Za-z0-9\p{L}._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,4}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ipv6": r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,80}\b|\bsk-[A-Za-z0-9-]{20,80}\b",
    "password": rf"{_LABEL}(?!{_PREFIX})[^\s\"',;]{{4,64}}",
    "secret": r"\b(?=[A-Fa-f]{0,63}[0-9])[0-9A-Fa-f]{32,64}\b",
    "card": r"(?<![\d-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w+])\+\d{8,14}(?!\w)",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLED}|(?:{_GIVEN}) {_WORD})",
}
#: What a text with any entity has; a quick look that spares most texts the whole pattern.
SIGN = rf"[0-9@]|{_PREFIX}|::|{_LABEL}|(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_TITLES})[. ]|(?:{_GIVEN}) \p{{Lu}})"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def session_key(spark: SparkSession) -> str:
    """The key that the session is set to; where none is, one drawn for this session."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(16))
    return spark.conf.get(KEY_SETTING)


def type_of(entity: Column) -> Column:
    """A word of a name found elsewhere in its text matches no pattern and is a name."""
    return F.coalesce(*[F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()], F.lit("name"))


def gender_of(name: Column) -> Column:
    """f, m or n of a name by its honorific, else by a given name at its begin."""
    known = {g: [*HONORIFICS[g], *GIVEN.get(g, ())] for g in HONORIFICS}
    first = F.regexp_replace(F.substring_index(name, " ", 1), r"\.$", "")
    titled = F.when(first.isin(*HONORIFICS["n"]) & F.substring_index(F.substring_index(name, " ", 2), " ", -1).isin(*GIVEN["f"]), "f").when(first.isin(*HONORIFICS["n"]) & F.substring_index(F.substring_index(name, " ", 2), " ", -1).isin(*GIVEN["m"]), "m")
    return F.coalesce(titled, F.when(first.isin(*known["f"]), "f").when(first.isin(*known["m"]), "m").otherwise("n"))


def _drawn(entity: Column, digest: Column, start: int = 0) -> Column:
    """The entity with each digit and letter drawn anew from digest's hexadecimal digits, class by class."""
    chars = F.split(entity, "")
    hexadecimal = entity.rlike("^(?:[0-9a-f]+|[0-9A-Fa-f]{32,64}|[0-9A-Fa-f]*:[0-9A-Fa-f:]*)$")

    def one(c: Column, i: Column) -> Column:
        at = F.pmod(i * 2 + start, F.lit(62)).cast("int") + 1
        n = F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int")
        pick = lambda letters: F.substring(F.lit(letters), F.pmod(n + i, F.lit(len(letters))).cast("int") + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), pick("0123456789"))
            .when(c.rlike("[a-f]") & hexadecimal, pick("abcdef"))
            .when(c.rlike("[A-F]") & hexadecimal, pick("ABCDEF"))
            .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХ"))
            .when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфх"))
            .when(c.rlike(r"\p{Lu}"), pick("ÀÉÈÖÜÄÇÑÍÓ"))
            .when(c.rlike(r"\p{L}"), pick("àéèöüäçñíó"))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, one), "")


def _check_digit(digits: Column) -> Column:
    """What makes digits, followed by it, a valid card number."""
    parts = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.pmod(F.lit(0) - F.aggregate(parts, F.lit(0), lambda a, x: a + x), F.lit(10)).cast("string")


def _account(entity: Column, drawn: Column) -> Column:
    """An account number with entity's country and format, drawn's signs and valid check digits."""
    country = F.substring(entity, 1, 2)
    body = F.substring(drawn, F.lit(5), F.length(entity))
    signs = F.split(F.concat(F.regexp_replace(body, " ", ""), country, F.lit("00")), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    left = F.aggregate(signs, F.lit(0), lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)).cast("int"))
    return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), body)


def surrogate(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, entity, attempt.cast("string")).cast("binary"), 256)
    number = lambda at, most: F.pmod(F.conv(F.substring(digest, at, 7), 16, 10).cast("long"), F.lit(most))
    plain = _drawn(entity, digest)
    more = F.when(attempt > PATIENCE, F.substring(digest, F.lit(1), attempt - PATIENCE)).otherwise(F.lit(""))
    email = F.concat(_drawn(F.substring_index(entity, "@", 1), digest), more, F.lit("@example.org"))
    octet = lambda at: (number(at, 254) + 1).cast("string")
    ip = F.concat_ws(".", octet(1), octet(8), octet(15), octet(22))
    drawn = F.concat(F.substring(entity, 1, 1), F.substring(plain, F.lit(2), F.length(entity)))
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    card = F.concat(body, _check_digit(F.regexp_replace(body, "[^0-9]", "")))
    kept = F.regexp_extract(entity, rf"^(?:{_PREFIX})", 0)
    access = F.concat(kept, F.substring(plain, F.length(kept) + 1, F.length(entity)))
    country = F.regexp_extract(entity, r"^\+\d{1,3}[ .-]", 0)
    phone = F.concat(country, F.substring(plain, F.length(country) + 1, F.length(entity)))
    gender = F.when(kind.endswith("_f"), "f").when(kind.endswith("_m"), "m").otherwise("n")
    lists = F.when(entity.rlike(r"^\p{IsCyrillic}"), F.concat(F.lit("cyrillic_"), gender)).otherwise(gender)
    listed = reduce(lambda out, k: F.when(lists == k, F.element_at(F.array(*[F.lit(x) for x in NAMES[k]]), (number(1, len(NAMES[k])) + 1).cast("int"))).otherwise(out), NAMES, F.lit("Kim"))
    # A name word that collides gets a drawn ending in its own script.
    shape = F.when(entity.rlike(r"^\p{IsCyrillic}"), F.repeat(F.lit("а"), attempt)).otherwise(F.repeat(F.lit("a"), attempt))
    name = F.concat(listed, _drawn(shape, digest, 9))
    by_kind = {"phone": phone, "ip": ip, "card": card, "key": access, "iban": _account(entity, plain)}
    out = reduce(lambda rest, k: F.when(kind == k, F.concat(by_kind[k], more)).otherwise(rest), by_kind, F.concat(plain, more))
    return F.when(kind == "email", email).when(kind.startswith("name"), name).otherwise(out)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, entity, surrogate) for distinct (type, entity): distinct surrogates, none of them an entity."""
    table = saved(entities.select("type", "entity").distinct().withColumn("attempt", F.lit(0)))
    while True:
        drawn = saved(table.withColumn("surrogate", surrogate(F.col("type"), F.col("entity"), F.col("attempt"), key)))
        unit = F.struct("type", "entity")
        first = drawn.groupBy("surrogate").agg(F.min(unit).alias("first"), F.count(F.lit(1)).alias("n"))
        taken = drawn.select(F.col("entity").alias("surrogate")).distinct().withColumn("taken", F.lit(True))
        clashes = first.filter("n > 1").join(taken, "surrogate", "full").select("surrogate", "first", F.coalesce("taken", F.lit(False)).alias("taken"))
        again = drawn.join(clashes, "surrogate", "left").withColumn("again", F.coalesce(F.col("taken") | (F.col("first").isNotNull() & (unit != F.col("first"))), F.lit(False)))
        if not again.filter("again").limit(1).count():
            dropped(table)
            return drawn.select("type", "entity", "surrogate")
        fresh = saved(again.select("type", "entity", (F.col("attempt") + F.col("again").cast("int")).alias("attempt")))
        dropped(table, drawn)
        table = fresh


def bare_words(found: Column) -> Column:
    """The words of the names among a text's entities, of two letters at least."""
    names = F.filter(found, lambda e: type_of(e) == "name")
    words = F.flatten(F.transform(names, lambda n: F.split(F.regexp_replace(n, rf"^(?:{_TITLES})\.? ", ""), " ")))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) > 1)), lambda x, y: F.length(y) - F.length(x))


def put_names(mentions: DataFrame) -> DataFrame:
    """(_row, _at, _nth, title, type, entity) for each word of each name; type tells the gender."""
    name, title = F.col("entity"), F.regexp_extract("entity", rf"^(?:{_TITLES})\.? ", 0)
    words = mentions.withColumn("title", title).withColumn("own", gender_of(name))
    words = words.select("_row", "_at", "title", "own", F.posexplode(F.split(F.substring(name, F.length("title") + 1, F.length(name)), " ")).alias("_nth", "word"))
    told = words.groupBy("_row", "word").agg(F.max(F.col("own") == "f").alias("f"), F.max(F.col("own") == "m").alias("m"))
    gender = F.when((F.col("own") == "n") & F.col("f") & ~F.col("m"), "f").when((F.col("own") == "n") & F.col("m") & ~F.col("f"), "m").otherwise(F.col("own"))
    return words.join(told, ["_row", "word"]).select("_row", "_at", "_nth", "title", F.concat(F.lit("name_"), gender).alias("type"), F.col("word").alias("entity"))


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """docs with text replaced, and n_entities and entity_types (in place of columns so named), for each row."""
    names, used = [c for c in docs.columns if c not in ("n_entities", "entity_types")], ["text"]
    docs = narrowed(docs.select(*names), used)
    has = F.coalesce(F.col("text").rlike(SIGN) & F.col("text").rlike(ANY), F.lit(False))
    none = docs.filter(~has).withColumns({"n_entities": F.lit(0).cast("long"), "entity_types": F.lit("")})
    found = docs.filter(has).withColumn("_bare", bare_words(F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))))
    bare = F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}])(?:"), F.array_join("_bare", "|"), F.lit(r")(?![\p{L}])"))
    found = found.withColumn("_pattern", F.when(F.size("_bare") > 0, bare).otherwise(F.lit(ANY))).drop("_bare")
    found = found.withColumn("_found", F.regexp_extract_all("text", F.concat(F.lit("("), F.col("_pattern"), F.lit(")")), F.lit(1)))
    rows = saved(found.withColumn("_row", F.monotonically_increasing_id()))
    mentions = rows.select("_row", F.posexplode("_found").alias("_at", "entity"))
    mentions = saved(mentions.withColumn("type", type_of(F.col("entity"))))
    words = saved(put_names(mentions.filter("type = 'name'")))
    others = mentions.filter("type <> 'name'").withColumn("title", F.when(F.col("type") == "password", F.regexp_extract("entity", f"^{_LABEL}", 0)).otherwise(F.lit("")))
    others = others.select("_row", "_at", F.lit(0).alias("_nth"), "title", "type", F.substring(F.col("entity"), F.length("title") + 1, F.length("entity")).alias("entity"))
    units = words.unionByName(others)
    parts = units.join(surrogates(units, key), ["type", "entity"]).groupBy("_row", "_at").agg(F.first("title").alias("title"), F.sort_array(F.collect_list(F.struct("_nth", "surrogate"))).alias("words"), F.first(F.substring_index("type", "_", 1)).alias("type"))
    parts = parts.select("_row", "_at", F.concat("title", F.array_join("words.surrogate", " ")).alias("surrogate"), "type")
    put = parts.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "surrogate", "type"))).alias("_put"))
    joined = rows.join(put, "_row")
    gaps = F.split("text", F.col("_pattern"), -1)
    pieces = F.zip_with(gaps, F.col("_put.surrogate"), lambda g, s: F.concat(F.coalesce(g, F.lit("")), F.coalesce(s, F.lit(""))))
    kinds = F.array_sort(F.array_distinct(F.col("_put.type")))
    out = joined.withColumns({"text": F.array_join(pieces, ""), "n_entities": F.size("_found").cast("long"), "entity_types": F.array_join(kinds, ",")})
    both = none.unionByName(out.select(*none.columns))
    return widened(both, [*names, "n_entities", "entity_types"], [*used, "n_entities", "entity_types"])
