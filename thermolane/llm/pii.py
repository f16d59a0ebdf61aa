"""Personal data replaced by keyed surrogates of the same type and format.

Only column expressions. Entities are found by one pattern; every distinct entity gets one surrogate in
the whole corpus, so mentions stay linked and different entities stay different.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import discard, stage

#: Titles that tell a gender, by script.
MALE = {"latin": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir"], "cyrillic": ["господин", "г-н"]}
FEMALE = {"latin": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"], "cyrillic": ["госпожа", "г-жа"]}
NEUTRAL = ["Dr", "Prof"]
#: Surrogate given names by gender, and family names, by script.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Leon", "Marco", "Oscar", "Paul"],
    ("latin", "f"): ["Alma", "Bianca", "Clara", "Diana", "Elena", "Flora", "Helena", "Irene", "Laura", "Maria", "Olga", "Paula"],
    ("latin", "n"): ["Alex", "Andrea", "Charlie", "Dominique", "Jamie", "Kim", "Noel", "Robin", "Sasha", "Toni"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Михаил", "Павел"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя"],
}
FAMILY_PARTS = {
    "latin": (["Al", "Ber", "Cor", "Dal", "Fer", "Gar", "Hol", "Kel", "Lan", "Mor", "Nor", "Ros", "Sel", "Tor", "Val", "Win"],
              ["ba", "de", "fi", "go", "la", "mi", "no", "ra", "se", "ti"],
              ["bert", "dal", "field", "ger", "lin", "man", "ner", "rick", "son", "ton"]),
    "cyrillic": (["Ан", "Бел", "Вол", "Гор", "Кир", "Лап", "Мор", "Нов", "Сав", "Тих"],
                 ["да", "ли", "мо", "ра", "ти"], ["ин", "ков", "нин", "шин"]),
}

_EDGE, _NEXT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = [*NEUTRAL, *(t for g in (MALE, FEMALE) for s in g.values() for t in s)]
#: Entity types in order of precedence. Each is a pattern without capturing groups.
TYPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": _EDGE + r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[abp]-[A-Za-z0-9-]{10,}|"
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _NEXT,
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _NEXT,
    "ip": r"(?<![\p{L}\p{N}_.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\.?\d)" + _NEXT,
    "phone": r"(?<![\p{L}\p{N}_])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|"
    r"\(\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})" + _NEXT,
    "ssn": _EDGE + r"\d{3}-\d{2}-\d{4}" + _NEXT,
    "card": _EDGE + r"\d(?:[ -]?\d){12,18}" + _NEXT,
    "name": _EDGE + "(?:" + "|".join(sorted(_TITLES, key=lambda t: -len(t))) + r")\.? \p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+)?" + _NEXT,
}
PATTERN = "|".join(TYPES.values())
#: A surrogate is drawn anew after a collision so often; then it gets a number that nothing else has.
DRAWS = 24


def _type_of(entity):
    out = F.lit("name")
    for name, pattern in reversed([*TYPES.items()][:-1]):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _digest(key: str, kind, entity, draw):
    """256 hexadecimal digits that only the key's holder can recompute."""
    seed = F.concat_ws("|", F.lit(key), kind, draw.cast("string"), entity)
    return F.concat(*[F.sha2(F.concat(F.lit(f"{part}|"), seed), 256) for part in range(4)])


def _number(digest, at, modulus: int):
    """A number below ``modulus`` from the digits at a place (repeating after 60 places)."""
    return F.pmod(F.conv(F.substring(digest, F.pmod(at * 4, F.lit(240)) + 1, F.lit(7)), 16, 10).cast("long"), F.lit(modulus))


def _same_format(entity, digest, hexadecimal):
    """Digits for digits and letters for letters of the same case; all else stays.

    A hexadecimal string gets hexadecimal digits of its case.
    """
    def one(i):
        c = F.substring(entity, i, F.lit(1))
        def of(alphabet):
            return F.substring(F.lit(alphabet), (_number(digest, i, len(alphabet)) + 1).cast("int"), F.lit(1))
        upper = F.upper(entity) == entity
        return (
            F.when(hexadecimal & upper, of("0123456789ABCDEF")).when(hexadecimal, of("0123456789abcdef"))
            .when(c.rlike("[0-9]"), of("0123456789")).when(c.rlike("[a-z]"), of("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(entity), F.lit(1))), one), "")


def _card(drawn):
    """The drawn digits with a right Luhn check digit at the end."""
    def weigh(i):
        d = F.element_at("digits", -1 - i) * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    places = F.sequence(F.lit(1), F.greatest(F.size("digits") - 1, F.lit(1)))
    total = F.aggregate(F.transform(places, weigh), F.lit(0), lambda s, d: s + d)
    check = F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")
    return F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), check)


def _name(entity, digest):
    """Title kept; given and family names of the title's gender and the name's script, as many as before."""
    title = F.regexp_extract(entity, r"^(\S+?\.?) ", 1)
    bare = F.regexp_replace(title, r"\.", "")
    cyrillic = F.regexp_replace(entity, r"^\S+ ", "").rlike(r"\p{IsCyrillic}")
    def any_of(groups):
        return bare.isin([t for s in groups.values() for t in s])
    def pick(values, at):
        return F.element_at(F.array(*map(F.lit, values)), (_number(digest, F.lit(at), len(values)) + 1).cast("int"))
    def whole(script):
        given = F.when(any_of(MALE), pick(GIVEN[script, "m"], 1)).when(any_of(FEMALE), pick(GIVEN[script, "f"], 1))
        given = given.otherwise(pick(GIVEN[script, "n"], 1))
        family = F.concat(*[pick(p, k + 2) for k, p in enumerate(FAMILY_PARTS[script])])
        two = F.regexp_extract(entity, r"^\S+ \p{L}+([ -])\p{L}+$", 1)
        return F.when(two != "", F.concat(given, two, family)).otherwise(family)
    return F.concat(title, F.lit(" "), F.when(cyrillic, whole("cyrillic")).otherwise(whole("latin")))


def _with_surrogates(df: DataFrame) -> DataFrame:
    """Adds ``surrogate`` to (entity, kind, digest). Each step is a column of its own, used by the next."""
    entity, kind, digest, drawn = F.col("entity"), F.col("kind"), F.col("digest"), F.col("drawn")
    mail_end = F.substring_index(entity, ".", -1)
    kept = (  # what stays in front
        F.when(kind == "phone", F.regexp_extract(entity, r"^(\+\d{1,3})[ .(-]", 1))
        .when(kind == "secret", F.regexp_extract(entity, "^(AKIA|gh[pousr]_|sk-|xox[abp]-|eyJ)", 1))
        .when(kind == "iban", F.substring(entity, 1, 2))
        .otherwise(F.lit(""))
    )
    df = df.withColumn("kept", kept).withColumn("rest", F.substring(entity, F.length("kept") + 1, F.length(entity)))
    df = df.withColumn("hex", (kind == "secret") & (F.col("kept") == "")).withColumn(
        "drawn", _same_format(F.col("rest"), digest, F.col("hex"))
    )
    octets = [F.lit(1) + _number(digest, F.lit(0), 223), *[_number(digest, F.lit(k), 256) for k in (1, 2, 3)]]
    digits = F.transform(F.split(F.regexp_replace("drawn", "[^0-9]", ""), ""), lambda d: d.try_cast("int"))
    df = df.withColumn("digits", F.when(kind == "card", digits))
    surrogate = (
        F.when(kind == "email", F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - F.length(mail_end)), mail_end))
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "card", _card(drawn))
        .when(kind == "name", _name(entity, digest))
        .otherwise(F.concat("kept", "drawn"))
    )
    return df.withColumn("surrogate", surrogate)


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(entity, surrogate) for a table of distinct entities; all surrogates differ, and none is an entity.

    Of entities that draw the same surrogate, the smallest keeps it and the others draw again.
    """
    entity, kind = F.col("entity"), F.col("kind")
    open_ = stage(entities.select("entity").distinct().withColumn("kind", _type_of(entity)), "entities")
    everyone, done = open_, []
    for draw in range(DRAWS):
        drawn = open_.withColumn("digest", _digest(key, kind, entity, F.lit(draw)))
        drawn = stage(_with_surrogates(drawn).select("entity", "kind", "surrogate"), "drawn")
        first = F.min("entity").over(Window.partitionBy("surrogate"))
        free = drawn.withColumn("first", first).where("entity = first").drop("first")
        free = free.join(everyone.select(entity.alias("surrogate")), "surrogate", "left_anti")
        for kept in done:
            free = free.join(kept.select("surrogate"), "surrogate", "left_anti")
        kept = stage(free.select("entity", "surrogate"), "surrogates")
        rest = stage(drawn.join(kept.select("entity"), "entity", "left_anti").select("entity", "kind"), "entities")
        discard(drawn)
        done.append(kept)
        open_ = rest
        if rest.isEmpty():
            break
    else:  # a format with too few values, such as two-digit numbers
        code = F.substring(F.sha2(F.concat(F.lit(f"{key}|last|"), entity), 256), 1, 32)
        done.append(open_.select("entity", F.concat(F.lit("["), F.upper(kind), F.lit("-"), code, F.lit("]")).alias("surrogate")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """All columns, the text with every entity replaced, and ``count_col``, the number of replacements.

    Entities are e-mail addresses, secrets (access keys, tokens, long hexadecimal strings), IBANs, IPv4
    addresses, phone, social security and payment card numbers, and names after a title. A surrogate
    depends on ``key`` and the entity alone, but for collisions in the corpus. Cards get a right check
    digit, names keep title, gender, script and number of parts, e-mail addresses their top-level
    domain, phone numbers their country code. Null and empty texts stay and count 0; a null text stays
    null. Repeated texts get equal replacements. A column named ``count_col`` is replaced.
    """
    columns = [c for c in docs.columns if c != count_col]
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    text = F.col(f"`{text_col}`")
    # The pattern is run once over all texts; what it finds is stored beside them.
    entities = F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))
    docs = stage(docs.withColumn("__found", entities), "marked")
    held = F.size("__found") > 0
    mark = F.sha2(text, 256)
    found = docs.where(held).select(mark.alias("__mark"), F.col("__found").alias("found"))
    found = stage(found.groupBy("__mark").agg(F.any_value("found").alias("found")), "found")
    spread = found.select("__mark", F.posexplode("found").alias("at", "entity"))
    names = stage(assign_surrogates(spread.select("entity"), key), "surrogate_map")
    subs = (
        spread.join(names, "entity").groupBy("__mark")
        .agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("subs"))
        .select("__mark", F.col("subs.surrogate").alias("__subs"))
    )
    subs = stage(subs, "subs")
    parts = F.split(text, PATTERN, -1)
    new = F.array_join(F.zip_with(parts, F.concat("__subs", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = docs.where(held).withColumn("__mark", mark).join(subs, "__mark")
    changed = changed.select(
        *[(new.alias(c) if c == text_col else F.col(f"`{c}`")) for c in columns],
        F.size("__subs").cast("long").alias(count_col),
    )
    rest = docs.where(~held).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias(count_col))
    return rest.unionByName(changed)
