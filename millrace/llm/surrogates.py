r"""Personal data replaced by keyed surrogates of the same type and format.

Detected: e-mail addresses of any length, phone numbers (a country code with ``+`` and 7 to 15 digits in any groups;
3-3-4 digits with separators), card numbers in an issuer's public range (13 to 19 digits, or groups of 4-4-4-4 and 4-6-5,
with a right check digit), IPv4 addresses, social security numbers, secrets assigned to a name (``token = "..."``: to the
closing quote, else to white space) and names after a title, secrets and names however long they are.  Digit strings that
fail their check, version numbers and the like stay as they are; so do phone numbers without ``+`` and separators, which
look like any other number, and national ones in other groups.

Every entity has a normal form (digits of a number, lower-cased address, name without its title); equal normal forms
get one surrogate in the whole corpus, so mentions still refer to each other.  A surrogate is drawn from a keyed
SHA-256 of type and normal form: digits for digits, letters of the same script for letters, a card with a right check
digit, a name of the title's gender and the name's script.  Collision check: entities whose surrogates would be equal,
or equal to another entity of the corpus, draw again, all but the smallest of them, until all are distinct.  The
surrogate then takes on each mention's own format: separators, country code, title and capitals.

Only texts with a detected entity take part in a join, by a digest of the text; all others pass through one scan.
Null and empty texts stay as they are; repeated rows are replaced alike; empty tables give no row.  Other columns pass
through whatever their names.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep

#: Titles by gender.  Doctors and professors have none.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "n": ("Dr", "Prof"),
}
#: Given names by script and gender; family names are made of the script's syllables.
GIVEN = {
    "Latin": {"f": ("Anna", "Clara", "Elena", "Ida", "Laura", "Maria", "Nora", "Sofia"), "m": ("Adam", "Bruno", "David", "Emil", "Hugo", "Leo", "Oskar", "Victor"), "n": ("Alex", "Robin", "Kim", "Sascha")},
    "Cyrillic": {"f": ("Анна", "Вера", "Елена", "Ольга"), "m": ("Антон", "Борис", "Иван", "Олег"), "n": ("Саша", "Женя")},
    "Greek": {"f": ("Άννα", "Ελένη", "Μαρία", "Σοφία"), "m": ("Γιώργος", "Νίκος", "Πέτρος", "Ανδρέας"), "n": ("Άλεξ", "Κρις")},
}
SYLLABLES = {
    "Latin": ("ba", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nes", "pol", "ran", "sen", "tal", "ver", "win", "zor"),
    "Cyrillic": ("ба", "вен", "гор", "дал", "кин", "лов", "мир", "нев", "пол", "рен", "сан", "тов"),
    "Greek": ("βα", "γεν", "δορ", "καλ", "λιν", "μαρ", "νες", "πολ", "ραν", "σεν", "ταλ", "φορ"),
}
ALPHABETS = {"Latin": "abcdefghijklmnopqrstuvwxyz", "Cyrillic": "абвгдежзийклмнопрстуфхцчшщэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_TITLE = "|".join(t for own in TITLES.values() for t in own)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAME = r"\p{Lu}[\p{L}'\-]++(?: \p{Lu}[\p{L}'\-]++)*+"
_SECRET_NAME = r"(?i:(?<![\p{L}\p{N}])(?:token|secret|password|passwd|api[_\-]?key|access[_\-]?key)[\"']?\s{0,3}[=:]\s{0,3})"
_SECRET_HEAD = _SECRET_NAME + r"[\"']?"
#: A secret's value to its real end: in quotes up to the same quote, of any length from 4; else up to white space and without
#: closing punctuation, if it has 16 characters, or 8 with a digit and a letter.  Values without a letter or digit (filling
#: dots) are none.
_SECRET_END = r"[^\s.,;:!?)\]}>\"']"
_SECRET = "|".join((
    r"\"(?=[^\"\n]*[A-Za-z0-9])[^\"\n]{4,}+(?=\")", r"'(?=[^'\n]*[A-Za-z0-9])[^'\n]{4,}+(?=')",
    rf"[\"']?(?=[^\s]*[A-Za-z0-9])[^\s\"']\S{{14}}\S*{_SECRET_END}", rf"[\"']?(?=\S*\d)(?=\S*[A-Za-z])[^\s\"']\S{{6}}\S*{_SECRET_END}",
))
_NATIONAL = r"(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)"
#: Country codes of one and two digits; all others have three.
_COUNTRY = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
PATTERN = "|".join((
    rf"{_SECRET_NAME}(?:{_SECRET})",
    r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    r"(?<![\d.])(?:\d{4}[ \-]){3}\d{4}(?!\d)",
    r"(?<![\d.])\d{4}[ \-]\d{6}[ \-]\d{5}(?!\d)",
    r"(?<![\d.])\d{13,19}(?!\d)",
    rf"(?<![\d(+])(?:\+1[ .\-]?)?{_NATIONAL}",
    # A country code and 7 to 15 digits in all, in any groups.
    r"(?<![\p{L}\d+])\+[1-9](?:[ \u00a0\u202f.\-/]?\(?\d\)?){6,14}(?!\d)",
    rf"(?<!\p{{L}})(?:{_TITLE})\.? {_NAME}",
))
#: Public issuer ranges of payment cards with their lengths.  A tenth of all digit strings has a right check
#: digit by chance; most of those lie outside these ranges.
ISSUERS = "|".join((
    "4[0-9]{12,18}",  # Visa
    "5[0-8][0-9]{11,17}", "(?:222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720)[0-9]{12}",  # Mastercard, Maestro
    "3[47][0-9]{13}",  # American Express
    "3(?:0[0-5]|[689][0-9])[0-9]{11,16}",  # Diners Club
    "35(?:2[89]|[3-8][0-9])[0-9]{12,15}",  # JCB
    "6(?:0|2|3|4[4-9]|5|7|9)[0-9]{11,17}",  # Discover, UnionPay, Maestro
))
#: What a text must hold to have an entity at all: cheap to look for.
_HINT = rf"[0-9@]|(?i:token|secret|passw|api[_\-]?key|access[_\-]?key)|(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}"
KINDS = ("email", "phone", "card", "ip", "ssn", "secret", "name")
#: After this many attempts a kind's own format has no room left (a country code with four free digits has 8,000 numbers):
#: further surrogates carry an extension, ``x`` and ever more digits.
_OWN_FORMAT = 20


def luhn(digits: str) -> str:
    """SQL for the check sum of a digit string; a right card number has 0."""
    own = f"int(substr({digits}, -i, 1))"
    return (
        f"(aggregate(sequence(1, length({digits})), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN {own} "
        f"ELSE {own} * 2 - CASE WHEN {own} > 4 THEN 9 ELSE 0 END END) % 10)"
    )


def _kind(raw: str) -> str:
    digits = f"regexp_replace({raw}, '[^0-9]', '')"
    return (
        f"CASE WHEN {raw} rlike '\\\\A{_sql(_SECRET_HEAD)}' THEN 'secret' WHEN contains({raw}, '@') THEN 'email' "
        f"WHEN {raw} rlike '\\\\p{{L}}' THEN 'name' WHEN {raw} rlike '\\\\A[0-9]+([.][0-9]+){{3}}\\\\z' AND length({digits}) <= 12 THEN 'ip' "
        f"WHEN {raw} rlike '\\\\A[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\\\\z' THEN 'ssn' "
        f"WHEN length({digits}) >= 13 AND {raw} rlike '\\\\A[0-9][0-9 -]+\\\\z' THEN "
        f"CASE WHEN {digits} rlike '\\\\A(?:{ISSUERS})\\\\z' AND {luhn(digits)} = 0 THEN 'card' END ELSE 'phone' END"
    )


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _norm(kind: str, raw: str) -> str:
    digits = f"regexp_replace({raw}, '[^0-9]', '')"
    return (
        f"CASE {kind} WHEN 'email' THEN lower({raw}) WHEN 'ip' THEN {raw} WHEN 'phone' THEN "
        f"CASE WHEN {raw} rlike '\\\\A[+]' AND NOT {digits} rlike '\\\\A1[0-9]{{10}}\\\\z' THEN concat('+', {digits}) ELSE right({digits}, 10) END "
        f"WHEN 'secret' THEN regexp_replace({raw}, '\\\\A{_sql(_SECRET_HEAD)}', '') "
        f"WHEN 'name' THEN lower(regexp_replace({raw}, '\\\\A(?:{_TITLE})[.]? ', '')) ELSE {digits} END"
    )


def _gender(raw: str) -> str:
    named = lambda g: "|".join(TITLES[g])
    return f"CASE WHEN {raw} rlike '\\\\A(?:{named('f')})[. ]' THEN 'f' WHEN {raw} rlike '\\\\A(?:{named('m')})[. ]' THEN 'm' ELSE 'n' END"


def mentions(docs: DataFrame) -> DataFrame:
    """Distinct texts with entities: __pii_key, at (position), raw, kind, norm, gender."""
    found = docs.where(_hit()).select(_key().alias("__pii_key"), "text").dropDuplicates(["__pii_key"])
    each = found.select("__pii_key", F.posexplode(_matches()).alias("at", "raw"))
    each = each.withColumn("kind", F.expr(_kind("raw"))).where("kind is not null")
    each = each.withColumn("norm", F.expr(_norm("kind", "raw")))
    return each.withColumn("gender", F.when(F.col("kind") == "name", F.expr(_gender("raw"))).otherwise(""))


def _matches() -> Column:
    return F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))


def _hit() -> Column:
    return F.coalesce(F.col("text").rlike(_HINT) & F.col("text").rlike(PATTERN), F.lit(False))


def _key() -> Column:
    return F.unhex(F.sha2("text", 256))


def _draw() -> dict[str, str]:
    """SQL for the surrogate of (kind, norm, gender, attempt): ``h`` holds 256 hex digits of the keyed digest."""
    num = lambda i: f"int(conv(substr(h, 1 + ({i}) * 2 % 254, 2), 16, 10))"
    digit = lambda i: f"string({num(i)} % 10)"
    digits = lambda n, skip="0": f"array_join(transform(sequence(1, {n}), i -> {digit(f'i + {skip}')}), '')"

    def letters(text: str, h: str = "h", alphabets=tuple(ALPHABETS.values())) -> str:
        at = f"int(conv(substr({h}, 1 + i * 2 % 254, 2), 16, 10))"
        arms = " ".join(
            f"WHEN c rlike '[{a}]' THEN substr('{a}', 1 + {at} % {len(a)}, 1) WHEN c rlike '[{a.upper()}]' THEN substr('{a.upper()}', 1 + {at} % {len(a)}, 1)"
            for a in alphabets
        )
        return (
            f"array_join(transform(split({text}, ''), (c, i) -> CASE WHEN c rlike '[0-9]' THEN string({at} % 10) {arms} "
            f"WHEN c rlike '\\\\p{{L}}' THEN substr('{ALPHABETS['Latin']}', 1 + {at} % 26, 1) ELSE c END), '')"
        )

    wide = f"CASE WHEN attempt >= {_OWN_FORMAT} THEN concat('x', {digits(f'attempt - {_OWN_FORMAT - 4}', '60')}) ELSE '' END"
    more = f"CASE WHEN attempt > 4 THEN {digits('attempt - 4', '100')} ELSE '' END"
    domain = f"concat({letters('regexp_extract(norm, _at_(.*)[.][^.]*$_q_, 1)', 'hd')}, '.', substring_index(norm, '.', -1))"
    domain = domain.replace("_at_", "'@").replace("_q_", "'")
    card = f"concat(substr(norm, 1, 4), {digits('length(norm) - 5')})"
    country = f"regexp_extract(norm, '\\\\A[+](?:{_COUNTRY}|[0-9]{{3}})', 0)"
    zero = luhn("concat(body, '0')")
    script = f"CASE WHEN norm rlike '[{ALPHABETS['Cyrillic']}]' THEN 'Cyrillic' WHEN norm rlike '[{ALPHABETS['Greek']}]' THEN 'Greek' ELSE 'Latin' END"
    array = lambda words: "array(" + ", ".join(f"'{w}'" for w in words) + ")"
    given = "CASE " + " ".join(
        f"WHEN script = '{s}' AND gender = '{g}' THEN {array(own)}" for s, by in GIVEN.items() for g, own in by.items()
    ) + " END"
    syllables = "CASE script " + " ".join(f"WHEN '{s}' THEN {array(own)}" for s, own in SYLLABLES.items()) + " END"
    return {
        "script": script, "body": f"CASE WHEN kind = 'card' THEN {card} END",
        "given": f"CASE WHEN kind = 'name' THEN {given} END", "parts": f"CASE WHEN kind = 'name' THEN {syllables} END",
        "surrogate": (
            f"CASE kind WHEN 'email' THEN concat({letters('substring_index(norm, _s_, 1)')}, {more}, '@', {domain}) "
            f"WHEN 'phone' THEN concat({country}, string(2 + {num(90)} % 8), {digits(f'length(norm) - length({country}) - 1')}, {wide}) WHEN 'ssn' THEN concat({digits('9')}, {wide}) "
            f"WHEN 'card' THEN concat(body, string((10 - {zero}) % 10), {wide}) "
            f"WHEN 'ip' THEN concat(string(1 + {num(0)} % 223), '.', string({num(1)}), '.', string({num(2)}), '.', string({num(3)})) "
            f"WHEN 'secret' THEN CASE WHEN norm rlike '\\\\A[0-9a-fA-F]+\\\\z' THEN concat({letters('norm', alphabets=('abcdef',))}, {more}) ELSE concat({letters('norm')}, {more}) END "
            f"ELSE lower(concat(CASE WHEN contains(norm, ' ') THEN concat(given[{num(60)} % size(given)], ' ') ELSE '' END, "
            f"array_join(transform(sequence(1, 2 + attempt), i -> parts[{num('i')} % size(parts)]), ''))) END"
        ).replace("_s_", "'@'"),
    }


def drawn(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    """Entities with the surrogate of one attempt."""
    told = F.concat_ws("\x01", F.lit(key), "kind", "norm", F.lit(str(attempt)))
    stream = F.concat(*[F.sha2(F.concat_ws("\x01", told, F.lit(str(i))), 256) for i in range(4)])
    places = F.concat(*[F.sha2(F.concat_ws("\x01", F.lit(key), F.substring_index("norm", "@", -1), F.lit(str(i))), 256) for i in range(4)])
    out = entities.withColumn("attempt", F.lit(attempt)).withColumn("h", stream).withColumn("hd", places)
    for name, sql in _draw().items():
        out = out.withColumn(name, F.expr(sql))
    return out.select("kind", "norm", "gender", "surrogate")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm, surrogate: one distinct surrogate for each distinct entity, none equal to an entity.

    An entity named with several genders takes the first of f, m, n.  Each attempt is one aggregate over the entities
    still without a surrogate; those that lose a collision go on to the next attempt.
    """
    real = keep(entities.groupBy("kind", "norm").agg(F.min("gender").alias("gender")), "entities")
    taken, rest = None, real
    for attempt in count():
        tried = keep(drawn(rest, key, attempt), "drawn")
        first = tried.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        first = first.join(real.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if taken is not None:
            first = first.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = keep(first.select("kind", "norm", "surrogate"), "surrogates")
        taken = won if taken is None else taken.union(won)
        rest = keep(tried.join(won, ["kind", "norm"], "left_anti").select("kind", "norm", "gender"), "rest")
        if rest.isEmpty():
            return taken


def _shown(kind: str, raw: str, norm: str, new: str) -> str:
    """SQL: the surrogate in the mention's format."""
    own, extension = f"replace(substring_index({new}, 'x', 1), '+', '')", f"regexp_extract({new}, 'x[0-9]+$', 0)"
    cased = f"CASE WHEN {raw} = upper({raw}) THEN upper({new}) ELSE {{}} END"
    fill = (
        f"aggregate(split({raw}, ''), struct(length({own}) - length(regexp_replace({raw}, '[^0-9]', '')) AS p, '' AS o), (s, c) -> "
        f"CASE WHEN c rlike '[0-9]' THEN struct(s.p + 1 AS p, concat(s.o, CASE WHEN s.p < 0 THEN c ELSE substr({own}, s.p + 1, 1) END) AS o) "
        f"ELSE struct(s.p AS p, concat(s.o, c) AS o) END, s -> s.o)"
    )
    head = f"substr({raw}, 1, length({raw}) - length({norm}))"
    name = f"substr({raw}, 1 + length({raw}) - length({norm}))"
    return (
        f"CASE {kind} WHEN 'email' THEN {cased.format(new)} WHEN 'ip' THEN {new} WHEN 'secret' THEN concat({head}, {new}) "
        f"WHEN 'name' THEN concat({head}, CASE WHEN {name} = upper({name}) THEN upper({new}) ELSE initcap({new}) END) ELSE concat({fill}, {extension}) END"
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The documents with entities replaced in ``text``, and ``__pii_counts`` (kind to number of mentions)."""
    each = keep(mentions(docs), "mentions")
    table = keep(surrogate_table(each.select("kind", "norm", "gender"), key), "surrogates")
    shown = each.join(table, ["kind", "norm"]).select("__pii_key", "at", "kind", F.expr(_shown("kind", "raw", "norm", "surrogate")).alias("new"))
    per_text = keep(shown.groupBy("__pii_key").agg(F.collect_list(F.struct("at", "kind", "new")).alias("__pii_new")), "replaced")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    doc = F.struct(*rest or [F.lit(1).alias("none")]).alias("doc")
    none = F.lit(None).cast("array<struct<at:int,kind:string,new:string>>")
    clean = docs.where(~_hit()).select(doc, "text", none.alias("new"))
    touched = docs.where(_hit()).select(doc, "text", _key().alias("__pii_key")).join(per_text, "__pii_key", "left")
    by_place = F.map_from_arrays(F.transform("__pii_new", lambda x: x["at"]), F.transform("__pii_new", lambda x: x["new"]))
    touched = touched.withColumn("by_place", by_place).withColumn("old", _matches())
    gaps = F.split("text", PATTERN, -1)
    filled = F.transform("old", lambda raw, i: F.coalesce(F.try_element_at("by_place", i), raw))
    whole = F.array_join(F.flatten(F.zip_with(gaps, F.array_append(filled, F.lit("")), lambda a, b: F.array(a, b))), "")
    text = F.when(F.col("__pii_new").isNotNull(), whole).otherwise(F.col("text"))
    both = clean.union(touched.select("doc", text.alias("text"), F.col("__pii_new").alias("new")))
    number = lambda kind: F.coalesce(F.size(F.filter("new", lambda m: m["kind"] == kind)), F.lit(0))
    counts = F.create_map([x for kind in KINDS for x in (F.lit(kind), F.greatest(number(kind), F.lit(0)).cast("long"))])
    names = [F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    return both.select(*names, counts.alias("__pii_counts"))
