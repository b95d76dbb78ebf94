"""Replacement of personal data by surrogates.

An entity is a kind and a canonical value, so that mentions which differ in case or separators
are the same entity. A name is one person whatever the title, and a bare family name is the person
of that name in its document, if there is one. Each distinct entity of the corpus gets one
surrogate, made from a keyed hash and of the same form; surrogates that meet each other or a real
value are made anew, in a wider form where the form has few values left. A mention is written in
its own format. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.session import stored

# Titles that precede names, by gender, and given names by gender and script.
TITLES = {
    "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа",
    "m": "Mr|Herr|Monsieur|Señor|Sr|г-н",
    "x": "Dr|Prof",
}
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Emma Eva Ida Irene Julia Laura Lea Lina Maria Marta Nina Nora Olga Paula Rita Rosa Sara Silvia Sofia Vera Viola",
    ("m", "latin"): "Adam Albert Anton Bruno Carl David Erik Felix Georg Hugo Jan Jonas Leo Marco Martin Max Oscar Otto Paul Peter Robert Simon Thomas Victor",
    ("x", "latin"): "Alex Andrea Chris Dominique Gabriel Jean Kim Maxime Noel Robin Sasha Toni",
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Полина София Юлия Яна",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег Павел Роман",
    ("x", "cyrillic"): "Валя Женя Саша",
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do ga ka ke ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta te ti to va ve",
    "cyrillic": "ба бе бо ва ве ви да де до ка ко ла ли ма ми на не ни ра ре ро са та ти",
}
ENDS = {"latin": "man berg dal ner ston rin", "cyrillic": "ко юк ич дзе ман ук"}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя"}

#: Attempts after which a surrogate grows by a digit each time, so that there are values left.
WIDEN = 4

_TITLE = "|".join(TITLES.values())
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: What a mention looks like, by kind, in the order in which they are tried.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}"
    r"|\+\d{1,3}(?:[ .\-]?\(\d{1,4}\))?(?:[ .\-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}])\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'\-]+(?: \p{{Lu}}[\p{{L}}'\-]+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

#: A cheap test that every text with a mention passes.
HINT = rf"[@\d]|(?:{_TITLE})\.? \p{{Lu}}"


def _kind(mention: Column) -> Column:
    """The first kind whose whole pattern is the mention."""
    found = F.lit("card")
    for kind, pattern in reversed(list(KINDS.items())):
        found = F.when(mention.rlike(f"^(?:{pattern})$"), kind).otherwise(found)
    return found


def _canonical(kind: Column, mention: Column) -> Column:
    """The same for all mentions of an entity: names start with their gender, x if open."""
    digits = F.regexp_replace(mention, r"\D", "")
    gender = F.lit("x")
    for sign in ("m", "f"):
        gender = F.when(mention.rlike(rf"^(?:{TITLES[sign]})\.? "), sign).otherwise(gender)
    name = F.regexp_replace(mention, rf"^(?:{_TITLE})\.? ", "")
    return (
        F.when(kind.isin("email", "secret"), F.lower(mention))
        .when(kind.isin("phone", "ssn", "card"), digits)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "name", F.concat(gender, F.lit(":"), F.lower(name)))
        .otherwise(mention)
    )


def _pick(words: str, number: str) -> str:
    """SQL for a word of a fixed list, by number."""
    listed = words.split()
    quoted = ", ".join(f"'{w}'" for w in listed)
    return f"element_at(array({quoted}), cast(pmod({number}, {len(listed)}) as int) + 1)"


def _letter(script: str, number: str) -> str:
    letters = LETTERS[script]
    return f"substr('{letters}', cast(pmod({number}, {len(letters)}) as int) + 1, 1)"


_CYRILLIC = "rlike(canonical, '[а-яёА-ЯЁ]')"

#: Character by character: letters of the same script and digits anew, all others as they are.
_SAME_FORM = f"""array_join(transform(sequence(1, length({{of}})), i ->
    transform(array(substr({{of}}, i, 1)), c -> case
        when c rlike '[0-9]' then cast(pmod(xxhash64(seed, i), 10) as string)
        when c rlike '[а-яё]' then {_letter("cyrillic", "xxhash64(seed, i)")}
        when c rlike '[А-ЯЁ]' then upper({_letter("cyrillic", "xxhash64(seed, i)")})
        when c rlike '\\\\p{{{{Lu}}}}' then upper({_letter("latin", "xxhash64(seed, i)")})
        when c rlike '\\\\p{{{{L}}}}' then {_letter("latin", "xxhash64(seed, i)")}
        else c end)[0]), '')"""

#: The sum of a number's digits of which card numbers have a multiple of ten.
_CHECKSUM = """aggregate(sequence(1, length({of})), 0, (sum, i) ->
    sum + transform(array(cast(substr({of}, -i, 1) as int) * if(i % 2 = 0, 2, 1)),
        d -> if(d > 9, d - 9, d))[0])"""


#: The remainder of an IBAN by 97, its first four characters last and letters as numbers.
_REMAINDER = """aggregate(sequence(1, length({of})), 0, (rest, i) ->
    transform(array(substr(concat(substr({of}, 5), substr({of}, 1, 4)), i, 1)), c ->
        if(c rlike '[0-9]', pmod(rest * 10 + cast(c as int), 97), pmod(rest * 100 + ascii(c) - 55, 97)))[0])"""

#: Digits behind the form, as many as attempts beyond those that keep it.
_MORE_DIGITS = f"""array_join(transform(filter(sequence(0, attempt), k -> k >= {WIDEN}),
    k -> cast(pmod(xxhash64(seed, 'more', k), 10) as string)), '')"""


def _name(gender: str, script: str) -> str:
    given = _pick(GIVEN[gender, script], "xxhash64(seed, 1)")
    middle = _pick(GIVEN[gender, script], "xxhash64(seed, 'middle')")
    family = ", ".join(_pick(SYLLABLES[script], f"xxhash64(seed, {k})") for k in (2, 3, 4))
    # more attempts, longer names: there are always names left
    more = _pick(SYLLABLES[script], "xxhash64(seed, 5 + k)")
    family = f"concat({family}, array_join(transform(sequence(0, attempt), k -> {more}), ''), {_pick(ENDS[script], 'xxhash64(seed, 0)')})"
    # as many names as the person has; of one only, the family name
    words = "size(split(canonical, ' '))"
    return (
        f"concat_ws(' ', if({words} > 1, {given}, null), if({words} > 2, {middle}, null), initcap({family}))"
    )


def _surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canonical, attempt) with the column surrogate, in canonical form.

    Phone numbers keep their first digit, cards and IBANs whether their check digits are right,
    IBANs their country. Addresses move to a reserved domain, IP addresses keep four numbers. From
    attempt :data:`WIDEN` on, numbers grow by digits and IP addresses have numbers above 255, so
    that a form of which the corpus has all values is left.
    """
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "canonical", F.col("attempt").cast("string")), 256)
    local = _SAME_FORM.format(of="substring_index(canonical, '@', 1)")
    form = _SAME_FORM.format(of="canonical")
    octets = ", ".join(
        f"if(attempt < {WIDEN + k}, 1 + pmod(xxhash64(seed, {k}), 254), 256 + pmod(xxhash64(seed, {k}), 744))"
        for k in range(4)
    )
    hexes = "array_join(transform(sequence(1, length(canonical)), i -> substr('0123456789abcdef', cast(pmod(xxhash64(seed, i), 16) as int) + 1, 1)), '')"
    names = " ".join(
        f"when canonical like '{g}:%' and {_CYRILLIC if s == 'cyrillic' else 'true'} then {_name(g, s)}"
        for s in ("cyrillic", "latin")
        for g in ("f", "m", "x")
    )
    made = F.expr(
        f"""case kind
        when 'email' then concat({local}, '@mail', cast(pmod(xxhash64(seed, 'd'), 1000000) as string),
            {_MORE_DIGITS}, '.example.org')
        when 'secret' then {hexes}
        when 'phone' then concat(substr(canonical, 1, 1), substr({form}, 2), {_MORE_DIGITS})
        when 'iban' then concat(substr(canonical, 1, 2), substr({form}, 3), {_MORE_DIGITS})
        when 'ip' then concat_ws('.', {octets})
        when 'name' then case {names} end
        else concat({form}, {_MORE_DIGITS}) end"""
    )
    zeroed = "concat(substr(made, 1, 2), '00', substr(made, 5))"
    check = f"lpad(cast(98 - {_REMAINDER.format(of=zeroed)} as string), 2, '0')"
    right = F.expr(f"{_REMAINDER.format(of='canonical')} = 1")
    iban = F.when(right, F.expr(f"concat(substr(made, 1, 2), {check}, substr(made, 5))"))
    shift = f"pmod(cast(substr(made, -1) as int) + {_CHECKSUM.format(of='canonical')} - {_CHECKSUM.format(of='made')}, 10)"
    card = F.expr(f"concat(substr(made, 1, length(made) - 1), cast({shift} as string))")
    return (
        entities.withColumn("seed", seed)
        .withColumn("made", made)
        .withColumn(
            "surrogate",
            F.when(F.col("kind") == "card", card)
            .when(F.col("kind") == "iban", F.coalesce(iban, F.col("made")))
            .otherwise(F.col("made")),
        )
        .drop("seed", "made")
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, canonical, surrogate: distinct entities get distinct surrogates, none a real value.

    Of entities whose surrogates meet, the least keeps its own; the others, and those that got a
    value that the corpus has, try again with the next attempt, until none is left. That ends: the
    forms of late attempts grow, so the share of values in use falls. Names are compared with the
    corpus in lower case and whatever their gender.
    """
    is_name = F.col("kind") == "name"
    bare = F.when(is_name, F.expr("substr(canonical, 3)")).otherwise(F.col("canonical"))
    shown = F.when(is_name, F.lower("surrogate")).otherwise(F.col("surrogate"))
    real = stored(entities.select("kind", "canonical").distinct())
    table = stored(_surrogates(real.withColumn("attempt", F.lit(0)), key))
    while True:
        owner = table.groupBy("kind", "surrogate").agg(F.min("canonical").alias("owner"))
        taken = real.select("kind", bare.alias("shown"), F.lit(True).alias("taken")).distinct()
        judged = stored(
            table.join(owner, ["kind", "surrogate"])
            .withColumn("shown", shown)
            .join(taken, ["kind", "shown"], "left")
            .withColumn("again", F.col("taken").isNotNull() | (F.col("owner") != F.col("canonical")))
            .select("kind", "canonical", "attempt", "surrogate", "again")
        )
        if judged.where("again").isEmpty():
            return judged.select("kind", "canonical", "surrogate")
        again = judged.where("again").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        table = stored(judged.where("not again").drop("again").unionByName(_surrogates(again, key)))


def resolve(typed: DataFrame) -> DataFrame:
    """``typed`` mentions (_id, _tie, kind, canonical, ...) with one canonical value per person.

    A name whose title leaves the gender open is that of the one gender the corpus has for it. A
    family name alone is the person of that family name in its document, if there is just one whose
    gender fits; otherwise it is a person of its own, the same in all documents. A document's
    different full names are held as a list.
    """
    names = typed.where("kind = 'name'").withColumn("bare", F.expr("substr(canonical, 3)"))
    sign, several = F.substring("canonical", 1, 1), F.contains("bare", F.lit(" "))
    whole, alone = names.where(several), names.where(~several).withColumn("family", F.col("bare"))
    genders = whole.groupBy("bare").agg(
        F.max((sign == "f").cast("int")).alias("f"), F.max((sign == "m").cast("int")).alias("m")
    )
    known = F.when(F.col("f") + F.col("m") == 1, F.when(F.col("f") == 1, "f").otherwise("m"))
    gender = F.when(sign == "x", F.coalesce(known, F.lit("x"))).otherwise(sign)
    whole = whole.join(genders, "bare").withColumn("canonical", F.concat(gender, F.lit(":"), "bare"))
    family = F.element_at(F.split("bare", " "), -1)
    persons = whole.groupBy("_id", "_tie", family.alias("family")).agg(
        F.collect_set("canonical").alias("persons")
    )
    fitting = F.filter(
        "persons",
        lambda p: (sign == "x") | (F.substring(p, 1, 1) == "x") | (F.substring(p, 1, 1) == sign),
    )
    found = F.when(F.size(fitting) == 1, F.element_at(fitting, 1))
    alone = alone.join(persons, ["_id", "_tie", "family"], "left").withColumn(
        "canonical", F.coalesce(found, "canonical")
    )
    columns = typed.columns
    return (
        typed.where("kind <> 'name'")
        .unionByName(whole.select(*columns))
        .unionByName(alone.select(*columns))
    )


#: Digits of the surrogate in the places of the mention's digits.
_IN_PLACES = """concat(array_join(transform(sequence(1, length(mention)), i ->
    if(substr(mention, i, 1) rlike '[0-9]',
       substr(surrogate, length(regexp_replace(substr(mention, 1, i), '[^0-9]', '')), 1),
       substr(mention, i, 1))), ''),
    substr(surrogate, length(regexp_replace(mention, '[^0-9]', '')) + 1))"""

#: Characters of the surrogate in the places of the mention's, its spaces kept.
_AROUND_SPACES = """concat(array_join(transform(sequence(1, length(mention)), i ->
    if(substr(mention, i, 1) = ' ', ' ',
       substr(surrogate, length(replace(substr(mention, 1, i), ' ', '')), 1))), ''),
    substr(surrogate, length(replace(mention, ' ', '')) + 1))"""

#: The names of the surrogate that a mention has: all, or the family name.
_NAMES = f"""transform(array(regexp_replace(mention, '^(?:{_TITLE})\\\\.? ', '')), own ->
    if(contains(own, ' '), surrogate, substring_index(surrogate, ' ', -1)))[0]"""


def _written() -> Column:
    """The surrogate in the format of the mention: case, separators, title."""
    return F.expr(
        f"""case
        when kind in ('phone', 'ssn', 'card') then {_IN_PLACES}
        when kind = 'iban' then {_AROUND_SPACES}
        when kind = 'name' then concat(regexp_extract(mention, '^(?:{_TITLE})\\\\.? ', 0),
            if(mention rlike '\\\\p{{Ll}}{{2}}', {_NAMES}, upper({_NAMES})))
        when kind in ('email', 'secret') and mention = upper(mention) and mention <> lower(mention)
            then upper(surrogate)
        else surrogate end"""
    )


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with all mentions in text replaced, and the
    new last column n_entities, the number of mentions replaced.

    The whole text is searched. Mentions of one entity get one surrogate in all documents. Texts
    without a mention pass by unshuffled; of the others, ids and mentions are joined with the
    entity table, whose hot entries Spark splits, and the results with the texts.

    A null text stays null. Null and repeated ids are no matter: rows that repeat id and text get
    equal results. A column named n_entities is replaced. An empty table gives an empty result.
    """
    text = F.col("row.text")
    rows = docs.drop("n_entities").select(F.struct("*").alias("row"))
    hinted = text.isNotNull() & text.rlike(HINT)
    mentions = F.when(hinted, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    found = F.coalesce(F.size(mentions), F.lit(0))
    rest = rows.where(F.coalesce(found <= 0, F.lit(True)))
    # rows of equal id and text are one
    tagged = rows.where(found > 0).select(
        "row",
        F.xxhash64(F.lit(1), "row.doc_id", text).alias("_id"),
        F.xxhash64(F.lit(2), text, "row.doc_id").alias("_tie"),
    )
    single = tagged.select("_id", "_tie", F.posexplode(mentions).alias("place", "mention"))
    typed = single.withColumn("kind", _kind(F.col("mention")))
    typed = stored(typed.withColumn("canonical", _canonical(F.col("kind"), F.col("mention"))))
    typed = stored(resolve(typed))
    replaced = (
        typed.join(assign(typed, key), ["kind", "canonical"])
        .select("_id", "_tie", F.struct("place", _written().alias("new")).alias("new"))
        .groupBy("_id", "_tie")
        .agg(F.sort_array(F.collect_set("new")).alias("new"))
    )
    # the text between the mentions, one part more than there are mentions
    changed = tagged.join(replaced, ["_id", "_tie"]).withColumn("parts", F.split(text, ANY, -1))
    joined = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.size("new")),
            lambda k: F.concat(F.get("parts", k), F.coalesce(F.get("new", k)["new"], F.lit(""))),
        ),
        "",
    )
    changed = changed.select(
        F.col("row").withField("text", joined).alias("row"), F.size("new").cast("long").alias("n")
    )
    return rest.select("row.*", F.lit(0).cast("long").alias("n_entities")).union(
        changed.select("row.*", F.col("n").alias("n_entities"))
    )
