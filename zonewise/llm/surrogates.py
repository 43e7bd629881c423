"""Personal data replaced by keyed surrogates.  SQL functions only.

Found are e-mail addresses, telephone numbers, payment cards, IPv4 addresses, social security numbers, access keys,
tokens, passwords, and names after a form of address.  A token or password without a letter or digit is a mask and stays.  A surrogate is drawn from a keyed hash of the type and
the normalised entity, so that all mentions of an entity get the same one (coreference) whatever their
punctuation or case, and no one without the key can tell.  It keeps the kind: digits stay digits, letters keep case and script,
separators, country codes, card brands, checksums, top-level domains and key prefixes stay as they are, octets stay octets,
and a given name keeps the gender of the form of address.  Names are replaced word by word, so that a surname
alone still points to the full name.  The digits of a telephone number are drawn from its normal form, ``+`` and country code for
an international one, and laid into the separators of each spelling.

Distinct entities keep distinct surrogates: all entities of the corpus are gathered once as a table, surrogates that
coincide with each other or with an entity of the corpus are drawn again, and made longer if that
does not help soon, until none does.  The few that
were drawn again travel to their documents by a join; all other documents never shuffle.

A null text stays null; a text without entities is returned as it is, character by character.  Rows that repeat
are treated alike.  Added columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm import bloom
from zonewise.llm.common import field, materialize

MARK, ESCAPE = "\u0002", "\u0001"
_NAME = r"\p{Lu}[\p{L}'’]+"
#: The text of an entity by type; a capturing group is not used, so that the patterns can be joined.
PATTERNS = {
    "email": r"(?<![\w.%+\-])[\w.%+\-]++@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "token": r"(?i:\b(?:token|secret|api_?key|apikey)\b\s*[=:]\s*\"?)(?=[_\-]*[A-Za-z0-9])[A-Za-z0-9_\-]{16,}",
    "password": r"(?i:\b(?:password|passwd|pwd)\b\s*[=:]\s*\"?)(?=[^\s\"]*[\p{L}\p{N}])[^\s\"]{4,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d.\-])[3-6]\d{3}(?:[ \-]?\d{4}){2}[ \-]?\d{3,4}(?![\d\-])",
    "phone": r"(?<![\w+])\+?\d{1,3}[ .\-]?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)|(?<![\w+(])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)"
    r"|(?<![\w+.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d.\-])|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)",
    "person": rf"\b(?:Mrs|Mr|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Господин|Госпожа|Г-жа|Г-н)\b\.? {_NAME}(?: {_NAME}){{0,2}}",
}
#: No entity starts inside a word, as most places of a text lie, and few words start like another entity than an address.
_OTHERS = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind != "email")
ALL = rf"(?<!\w)(?:(?:{PATTERNS['email']})|(?=[\d+(A-ZГaspt])(?:{_OTHERS}))"
#: The country code at the start of an international number's normal form.
COUNTRY = "^[+](?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Draws after which addresses, tokens and passwords grow by a character each time.
PLAIN_DRAWS = 3
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Госпожа|Г-жа)"
# Syllables and endings that surrogate names are made of.
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga go ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе би бо ва ве ви во га го да де ди до жа за зе ка ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се со та те ти то".split(),
}
ENDINGS = {
    ("latin", "f"): ["lia", "nna", "ra", "tta"],
    ("latin", "m"): ["rd", "n", "s", "ck"],
    ("cyrillic", "f"): ["на", "ия", "ла", "ра"],
    ("cyrillic", "m"): ["н", "р", "ст", "в"],
    ("latin", "s"): ["ner", "ton", "sen", "man"],
    ("cyrillic", "s"): ["нко", "вич", "чук", "дзе"],
}

#: Ranges of letters by script, first and number; letters and digits of other scripts become a-z.
SCRIPTS = {
    "[\u0430-\u045F]": (0x430, 32), "[\u0400-\u042F]": (0x410, 32), r"[\p{IsGreek}&&\p{Ll}]": (0x3B1, 25), r"\p{IsGreek}": (0x391, 17), r"\p{IsHan}": (0x4E00, 20902),
    r"\p{IsHiragana}": (0x3042, 82), r"\p{IsKatakana}": (0x30A2, 82), r"\p{IsHangul}": (0xAC00, 11172), r"\p{IsHebrew}": (0x5D0, 27), r"\p{IsArabic}": (0x627, 20),
    r"\p{IsDevanagari}": (0x905, 53), r"\p{IsThai}": (0xE01, 46), r"\p{N}": (0x30, 10), r"\p{Lu}": (0x41, 26),
}


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _normal(kind: Column, text: Column) -> Column:
    """What two mentions of one entity have in common."""
    digits = F.regexp_replace(text, r"\D", "")
    value = F.regexp_replace(text, r"^.*?[=:]\s*\"?", "")
    return (
        F.when((kind == "phone") & text.rlike(r"^\+|^\d+[ .\-]?\("), F.concat(F.lit("+"), digits))
        .when(kind.isin("card", "phone", "ssn"), digits)
        .when(kind == "email", F.lower(text))
        .when(kind.isin("token", "password"), value)
        .when(kind.isin("given:f", "given:m", "surname"), F.lower(text))
        .otherwise(text)
    )


def _kind(text: Column) -> Column:
    """The type of an entity's text: the first pattern that it fits as a whole."""
    out = F.lit("phone")
    for name in reversed([n for n in PATTERNS if n != "phone"]):
        out = F.when(text.rlike(rf"^(?:{PATTERNS[name]})$"), name).otherwise(out)
    return out


def _stream(key: str, kind: str, normal: str, attempt: str) -> str:
    """128 pairs of hash digits as text, drawn with the key."""
    inner = f"sha2(concat('{key}', '|', {kind}, '|', {normal}, '|', cast({attempt} AS string)), 256)"
    return "concat(" + ", ".join(f"sha2(concat('{key}', '{i}', {inner}), 256)" for i in range(4)) + ")"


def _draw(stream: str, at: str) -> str:
    """The number, 0 to 65535, for a place."""
    return f"cast(conv(substring({stream}, 1 + ({at}) * 4 % 252, 4), 16, 10) AS int)"


def _letter(c: str, draw: str) -> str:
    """Another character of the same kind."""
    def of(first: int, size: int) -> str:
        return f"chr({first} + {draw} % {size})"

    cyrillic = [f"'{chr(i)}'" for i in range(0x430, 0x450)]
    upper = [f"'{chr(i)}'" for i in range(0x410, 0x430)]
    return (
        f"CASE WHEN {c} BETWEEN '2' AND '9' THEN {of(50, 8)} WHEN {c} BETWEEN '0' AND '1' THEN {of(48, 10)} "
        f"WHEN {c} BETWEEN 'a' AND 'z' THEN {of(97, 26)} WHEN {c} BETWEEN 'A' AND 'Z' THEN {of(65, 26)} "
        f"WHEN {c} BETWEEN 'а' AND 'я' THEN element_at(array({', '.join(cyrillic)}), 1 + {draw} % 32) "
        f"WHEN {c} BETWEEN 'А' AND 'Я' THEN element_at(array({', '.join(upper)}), 1 + {draw} % 32) "
        f"WHEN {c} RLIKE '[\\\\p{{L}}\\\\p{{N}}]' THEN {_foreign(c, draw)} ELSE {c} END"
    )


def _foreign(c: str, draw: str) -> str:
    """Another letter of the same script."""
    cases = " ".join(f"WHEN {c} RLIKE '{pattern.replace(chr(92), chr(92) * 2)}' THEN array({first}, {size})" for pattern, (first, size) in SCRIPTS.items())
    return f"element_at(transform(array(CASE {cases} ELSE array(97, 26) END), r -> decode(unhex(lpad(hex(r[0] + {draw} % r[1]), 4, '0')), 'UTF-16BE')), 1)"


def _respell(text: str, stream: str, start: str = "0", hexadecimal: bool = False) -> str:
    """``text`` with each letter and digit replaced; the n-th letter or digit depends on n, not on separators."""
    draw = _draw(stream, f"({start}) + a.n")
    new = _letter("c", draw)
    if hexadecimal:
        new = f"CASE WHEN c BETWEEN 'a' AND 'f' THEN chr(97 + {draw} % 6) ELSE {new} END"
    plain = r"c RLIKE '[\\p{L}\\p{N}]'"
    return (
        f"aggregate(split({text}, ''), named_struct('t', '', 'n', 0), (a, c) -> named_struct('t', concat(a.t, {new}), "
        f"'n', a.n + IF({plain}, 1, 0)), a -> a.t)"
    )


def _octets(text: str, stream: str) -> str:
    return f"array_join(transform(split({text}, '[.]'), (o, i) -> cast(1 + {_draw(stream, 'i')} % 254 AS string)), '.')"


def _card(text: str, stream: str) -> str:
    """The first digit stays; the last makes the checksum as right or wrong as it was."""
    digits = f"regexp_replace({text}, '[^0-9]', '')"
    body = f"concat(left({digits}, 1), {_respell(f'substring({digits}, 2, length({digits}) - 2)', stream)})"
    last = f"element_at(filter(array('0','1','2','3','4','5','6','7','8','9'), d -> luhn_check(concat({body}, d)) = luhn_check({digits})), 1)"
    return _laid(text, f"concat({body}, {last})")


def _laid(text: str, digits: str) -> str:
    """``text`` with its digits replaced by ``digits`` in order."""
    return (
        f"element_at(transform(array({digits}), f -> aggregate(split({text}, ''), named_struct('t', '', 'n', 1), (a, c) -> named_struct('t', concat(a.t, "
        f"IF(c RLIKE '[0-9]', substring(f, a.n, 1), c)), 'n', a.n + IF(c RLIKE '[0-9]', 1, 0)), a -> a.t)), 1)"
    )


def _name(text: str, kind: str, stream: str, attempt: str) -> str:
    """A made-up name of the same gender and script, capitalised like the old one."""
    def made(script: str) -> str:
        syllables = _array(SYLLABLES[script])
        parts = f"array_join(transform(sequence(1, 2 + least({attempt}, 40)), i -> element_at({syllables}, 1 + {_draw(stream, 'i')} % {len(SYLLABLES[script])})), '')"
        ends = " ".join(f"WHEN '{k}' THEN {_array(ENDINGS[script, e])}" for k, e in (("given:f", "f"), ("given:m", "m")))
        ends = f"CASE {kind} {ends} ELSE {_array(ENDINGS[script, 's'])} END"
        return f"initcap(concat({parts}, element_at({ends}, 1 + {_draw(stream, '0')} % 4)))"

    made_up = f"IF({text} RLIKE '\\\\p{{IsCyrillic}}', {made('cyrillic')}, {made('latin')})"
    return f"IF({text} = upper({text}), upper({made_up}), {made_up})"


def _surrogate(kind: str, text: str, key: str, normal: str, attempt: str) -> str:
    """SQL for the surrogate of one entity."""
    value = f"regexp_extract({text}, '(?s)^.*?[=:]\\\\s*\"?', 0)"
    rest = f"substring({text}, length({value}) + 1)"
    domain = f"substring_index({text}, '@', -1)"
    top = f"substring_index({text}, '.', -1)"
    host = f"left({domain}, length({domain}) - length({top}))"
    country = f"regexp_extract({normal}, '{COUNTRY}', 0)"
    phone = _laid(text, f"concat(substring({country}, 2), {_respell(f'substring({normal}, length({country}) + 1)', 's')})")
    domain_stream = _stream(key, "'domain'", f"lower({host})", attempt)
    longer = f"left(s, greatest({attempt} - {PLAIN_DRAWS}, 0))"
    email = f"concat({_respell(f'substring_index({text}, {chr(39)}@{chr(39)}, 1)', 's')}, {longer}, '@', {_respell(host, 'z')}, {top})"
    body = (
        f"CASE WHEN {kind} = 'email' THEN element_at(transform(array({domain_stream}), z -> {email}), 1) "
        f"WHEN {kind} = 'key' THEN concat(left({text}, 4), {_respell(f'substring({text}, 5)', 's')}) "
        f"WHEN {kind} = 'token' THEN concat({value}, {_respell(rest, 's', hexadecimal=True)}, {longer}) "
        f"WHEN {kind} = 'password' THEN concat({value}, {_respell(rest, 's')}, {longer}) "
        f"WHEN {kind} = 'ip' THEN {_octets(text, 's')} WHEN {kind} = 'card' THEN {_card(text, 's')} "
        f"WHEN {kind} IN ('given:f', 'given:m', 'surname') THEN {_name(text, kind, 's', attempt)} "
        f"WHEN {kind} = 'phone' THEN {phone} ELSE {_respell(text, 's')} END"
    )
    return f"element_at(transform(array({_stream(key, kind, normal, attempt)}), s -> {body}), 1)"


def _pieces(text: Column) -> Column:
    """The text cut at its entities; every second piece is one.  Marks of the text itself are escaped."""
    safe = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "a")), F.lit(MARK), F.lit(ESCAPE + "b"))
    return F.split(F.regexp_replace(safe, ALL, f"{MARK}$0{MARK}"), MARK, -1)


def _units(pieces: Column) -> Column:
    """Every piece as an array of ``kind, text`` units: plain text has no kind, a person is its words."""
    plain = lambda text: F.struct(F.lit(None).cast("string").alias("kind"), text.alias("text"))

    def words(person: Column) -> Column:
        gender = F.when(person.rlike(FEMALE), "given:f").otherwise("given:m")
        parts = F.split(person, "(?<= )|(?= )")
        return F.transform(
            parts,
            lambda word, i: F.struct(
                F.when((i == 0) | (word == " "), F.lit(None)).when(i == F.size(parts) - 1, "surname").otherwise(gender).alias("kind"),
                word.alias("text"),
            ),
        )

    def of(piece: Column, i: Column) -> Column:
        kind = _kind(piece)
        return F.when(i % 2 == 0, F.array(plain(piece))).when(kind == "person", words(piece)).otherwise(F.array(F.struct(kind.alias("kind"), piece.alias("text"))))

    return F.flatten(F.transform(pieces, of))


def _with_normal(units: Column) -> Column:
    return F.transform(units, lambda u: F.struct(u["kind"].alias("kind"), u["text"].alias("text"), _normal(u["kind"], u["text"]).alias("normal")))


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``x_row, x_units``: each row, and its text as plain and personal units (null for a null text)."""
    return docs.select(F.struct("*").alias("x_row"), _with_normal(_units(_pieces(field(text_col)))).alias("x_units"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, normal, attempt``, stored: how often the surrogate of each entity had to be drawn.

    ``entities`` has ``kind, normal, text`` with one spelling of each.
    """
    known = materialize(entities)
    drawn = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = drawn.withColumn("new", F.expr(_surrogate("kind", "text", key, "normal", "attempt")))
        drawn = materialize(drawn.withColumn("new_normal", _normal(F.col("kind"), F.col("new"))))
        family = F.split("kind", ":")[0]
        first = drawn.groupBy(family.alias("family"), "new_normal").agg(F.min(F.struct("normal", "kind")).alias("first"), F.count(F.lit(1)).alias("n"))
        twice = first.filter("n > 1").select("family", F.col("new_normal").alias("taken"), "first")
        of = known.select(F.split("kind", ":")[0].alias("family"), F.col("normal").alias("taken")).distinct()
        taken = materialize(
            twice.unionByName(of.withColumn("first", F.lit(None).cast("struct<normal:string,kind:string>")))
            .groupBy("family", "taken").agg(F.max("first").alias("first"), F.count_if(F.col("first").isNull()).alias("real"))
        )
        again = (F.col("real") > 0) | ~F.struct("normal", "kind").eqNullSafe(F.col("first"))
        both = drawn.withColumn("family", family).join(taken, (F.col("new_normal") == F.col("taken")) & (family == taken["family"]), "left").select(
            "kind", "normal", "text", "attempt", F.coalesce(F.col("taken").isNotNull() & again, F.lit(False)).alias("again")
        )
        drawn = materialize(both)
        if drawn.filter("again").isEmpty():
            return drawn.select("kind", "normal", "attempt")
        drawn = drawn.withColumn("attempt", F.col("attempt") + F.col("again").cast("int")).drop("again")


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced, and ``n_entities``, ``entity_types`` (type to count) added."""
    units = detect(docs, text_col)
    found = units.select(F.explode_outer("x_units").alias("u")).filter("u.kind IS NOT NULL").select("u.kind", "u.normal", "u.text")
    entities = found.groupBy("kind", "normal").agg(F.min("text").alias("text"))
    redrawn = materialize(assign(entities, key).filter("attempt > 0"))
    count = redrawn.count()
    attempts = "map<string,int>"
    if count == 0:
        ready = units.withColumn("x_attempts", F.lit(None).cast(attempts))
    else:
        ready = _with_attempts(units, redrawn, count)
    place = "concat(u.kind, '|', u.normal)"
    new = _surrogate("u.kind", "u.text", key, "u.normal", f"coalesce(try_element_at(x_attempts, {place}), 0)")
    done = ready.withColumn("x_new", F.expr(f"array_join(transform(x_units, u -> IF(u.kind IS NULL, u.text, {new})), '')"))
    plain = F.replace(F.replace("x_new", F.lit(ESCAPE + "b"), F.lit(MARK)), F.lit(ESCAPE + "a"), F.lit(ESCAPE))
    kinds = F.transform(F.filter("x_units", lambda u: u["kind"].isNotNull()), lambda u: u["kind"])
    counted = F.aggregate(
        F.array_sort(F.array_distinct(kinds)), F.create_map().cast("map<string,int>"),
        lambda m, k: F.map_concat(m, F.create_map(k, F.size(F.filter(kinds, lambda x: x == k)))),
    )
    added = {"n_entities": F.coalesce(F.size(kinds), F.lit(0)), "entity_types": counted}
    kept = [plain.alias(c) if c == text_col else F.col("x_row").getField(c).alias(c) for c in docs.columns if c.lower() not in added]
    return done.select(*kept, *[c.alias(n) for n, c in added.items()])


def _with_attempts(units: DataFrame, redrawn: DataFrame, count: int) -> DataFrame:
    """``x_attempts`` for rows that hold an entity drawn again.  Only rows that may hold one shuffle."""
    words = bloom.words_for(count)
    table = materialize(bloom.members(redrawn, F.xxhash64("kind", "normal"), words))
    row_key = F.xxhash64(F.to_json("x_row"))
    mentions = units.select(row_key.alias("x_of"), F.explode_outer("x_units").alias("u")).filter("u.kind IS NOT NULL").select("x_of", "u.kind", "u.normal").distinct()
    likely = bloom.probe(mentions, F.xxhash64("kind", "normal"), table, words, "x_maybe").filter("x_maybe").drop("x_maybe")
    wanted = likely.join(redrawn, ["kind", "normal"]).groupBy("x_of").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit("|"), "normal"), "attempt"))).alias("x_attempts")
    )
    wanted = materialize(wanted)
    rows = wanted.count()
    words = bloom.words_for(rows)
    keyed = units.withColumn("x_key", row_key)
    flagged = bloom.probe(keyed, F.xxhash64("x_key"), bloom.members(wanted, F.xxhash64("x_of"), words), words, "x_maybe")
    alone = flagged.filter("NOT x_maybe").select("x_row", "x_units", F.lit(None).cast("map<string,int>").alias("x_attempts"))
    joined = flagged.filter("x_maybe").join(wanted, F.col("x_key") == F.col("x_of"), "left").select("x_row", "x_units", "x_attempts")
    return alone.unionByName(joined)
