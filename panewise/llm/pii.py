"""PII surrogates; DataFrame functions only.

Entities are found by one pattern of alternatives (``TYPES``, the first that matches at a place
wins). Each distinct entity, in its canonical form (lower-cased mail, digits of a number, lower-cased name), gets one surrogate for
the whole corpus, so mentions that corefer stay equal whatever their punctuation or case. Surrogates
are derived from SHA-512 of key, type, canonical form and attempt, and keep type and format: digits
stay digits, letters keep script and case, separators stay; addresses keep their top-level domain, numbers their length,
card numbers whether their check digit holds, IPv4 octets their length and range, persons the gender
of their title and the script of their letters. The parts of a person's name are
replaced one by one, so a family name alone corefers with the full name; so are the two sides of a mail address.
A given name under a neutral title is that of the gender it has most often elsewhere in the corpus (ties: female), if any;
with both a male and a female bearer, it has a surrogate for each. When the list of given names is used up, invented ones with the endings
of the gender follow. Initials become other letters, not checked for collisions. A name that a title
introduces in a text is replaced, written like that, at all its other places in this text.

Collision checks: surrogates of a type must differ from each other and from every real entity of
that type; all names of a script are one type, whatever their gender and place. Of entities that collide, the one with the smallest hash keeps its surrogate, the
others try again with the next attempt; from ``WIDEN`` attempts on a surrogate grows by a keyed suffix (an IPv4
address is drawn from all unicast and multicast ones, whatever the length of their octets), so the
loop ends even when a format has too few values.

``n_entities`` counts what the pattern finds. If there is a column of that name it stays, and the count is
the first of ``n_entities_2``, ``n_entities_3``, ... that is free. Null texts stay null. Rows without entities are untouched and not shuffled. Rows that repeat
an id are told apart by their text. All other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import written

WIDEN, MAX_ATTEMPTS = 8, 40

# Titles by gender; what follows them is taken for a name.
MALE = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа")
NEUTRAL = ("Dr", "Prof", "Mx")
# Given names by gender and script.
GIVEN = {
    "m": ("Adam", "Anton", "Bruno", "Carl", "David", "Erik", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Noah", "Oscar", "Paul", "Ralph", "Simon", "Tom", "Victor"),
    "f": ("Alice", "Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Hanna", "Ines", "Julia", "Karin", "Laura", "Maria", "Nina", "Olga", "Paula", "Rosa", "Sofia", "Tina", "Vera"),
    "m_cyrillic": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Олег", "Павел", "Роман", "Степан", "Фёдор", "Юрий"),
    "f_cyrillic": ("Алла", "Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "Раиса", "Софья", "Тамара", "Юлия"),
}
# Syllables of invented family names.
SYLLABLES = {"latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo wa wo za".split(), "cyrillic": "ба бе бо ва ве во га го да де до за зо ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то".split()}

# Endings of invented given names.
ENDINGS = {"m": ("us", "ard", "ert", "or"), "f": ("ina", "elle", "issa", "ia"), "m_cyrillic": ("ан", "ор", "ислав", "ей"), "f_cyrillic": ("ина", "ия", "ана", "елла")}

_EDGE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_TITLES = "|".join((*MALE, *FEMALE, *NEUTRAL))
#: Name and pattern of each type, in order of precedence. No pattern has a capturing group.
TYPES = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]*[\p{L}\p{N}]@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+\p{L}{2,}"),
    ("secret", _EDGE + r"(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abp]-[A-Za-z0-9-]{10,})" + _END),
    ("iban", _EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END),
    ("ip", r"(?<![\p{L}\p{N}_.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}_]|\.[0-9])"),
    ("ssn", r"(?<![\p{L}\p{N}_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}_-])"),
    ("card", _EDGE + r"(?:[0-9]{4}[ -]){3}[0-9]{4}" + _END + "|" + _EDGE + r"[0-9]{13,19}" + _END),
    ("phone", r"(?<![\p{L}\p{N}_])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\p{L}\p{N}_-])"),
    ("person", _EDGE + rf"(?:{_TITLES})\.? (?:\p{{Lu}}\. ){{0,3}}{_NAME}(?: (?:\p{{Lu}}\. )?{_NAME}){{0,2}}"),
)
PATTERN = "|".join(f"(?:{p})" for _, p in TYPES)


def _literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def _type_of(entity: str) -> Column:
    """The type whose pattern matches the whole entity."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(TYPES):
        # look-arounds hold already where the entity was found
        out = F.when(F.col(entity).rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _canonical(kind: str, entity: str) -> Column:
    digits = F.regexp_replace(entity, "[^0-9]", "")
    compact = F.upper(F.regexp_replace(entity, "[^\\p{L}0-9]", ""))
    return F.when(F.col(kind).isin("phone", "card", "ssn"), digits).when(F.col(kind) == "iban", compact).when(F.col(kind).isin("ip", "secret"), F.col(entity)).otherwise(F.lower(entity))


def _noise(key: str, *parts: str) -> str:
    """SQL for an array of 128 numbers from 0 to 255, derived from the key and the parts."""
    seed = ", '|', ".join(parts)
    digest = f"sha2(concat('{_literal(key)}', '|', {seed}), 512)"
    both = f"concat({digest}, sha2(concat('{_literal(key)}', '|2|', {seed}), 512))"
    # bound to a variable, the hash is computed once and not for each number
    return f"transform(array({both}), h -> transform(sequence(0, 127), i -> cast(conv(substring(h, 2 * i + 1, 2), 16, 10) as int)))[0]"


def _masked(text: str, noise: str) -> str:
    """SQL: every letter and digit of ``text`` replaced by one of its own kind, other characters kept."""
    pick = "substring('{0}', {1}[i % 128] % {2} + 1, 1)"
    kinds = [("0123456789", "[0-9]"), ("abcdefghijklmnopqrstuvwxyz", "[a-z]"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[A-Z]"), ("абвгдежзиклмнопрстуфхцчшэюя", "[\\\\p{IsCyrillic}&&\\\\p{Ll}]"), ("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "[\\\\p{IsCyrillic}&&\\\\p{Lu}]"), ("αβγδεζηθικλμνξοπρστυφχψω", "[\\\\p{IsGreek}&&\\\\p{Ll}]"), ("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "[\\\\p{IsGreek}&&\\\\p{Lu}]"), ("abcdefghijklmnopqrstuvwxyz", "[\\\\p{IsLatin}&&\\\\p{Ll}]"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[\\\\p{IsLatin}&&\\\\p{Lu}]")]
    cases = " ".join(f"WHEN c RLIKE '^{regex}$' THEN {pick.format(chars, noise, len(chars))}" for chars, regex in kinds)
    return f"array_join(transform(split({text}, ''), (c, i) -> CASE {cases} ELSE c END), '')"


def _luhn(digits: str) -> str:
    """SQL: sum of the digits of a number as its check digit counts them, modulo 10."""
    d = f"reverse(split({digits}, ''))"
    value = "cast(c as int)"
    return f"aggregate(transform({d}, (c, i) -> CASE WHEN i % 2 = 1 THEN 2 * {value} - CASE WHEN {value} > 4 THEN 9 ELSE 0 END ELSE {value} END), 0, (x, y) -> x + y) % 10"


def _surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, form, attempt) with ``surrogate``, the canonical form of the replacement."""
    e = entities.withColumn("noise", F.expr(_noise(key, "kind", "form", "cast(attempt as string)")))
    # both sides of a mail address have their own noise; the domain's does not depend on the local part
    e = e.withColumn("user", F.substring_index("form", "@", 1)).withColumn("host", F.substring_index("form", "@", -1))
    e = e.withColumn("top", F.substring_index("host", ".", -1)).withColumn("labels", F.expr("substring(host, 1, length(host) - length(top) - 1)"))
    e = e.withColumn("host_noise", F.expr(_noise(key, "'host'", "host")))
    email = f"concat({_masked('user', 'noise')}, '@', {_masked('labels', 'host_noise')}, '.', top)"
    octet = "CASE length(c) WHEN 1 THEN noise[i] % 9 + 1 WHEN 2 THEN 10 + noise[i] % 90 ELSE 100 + (noise[i] * 256 + noise[i + 4]) % 155 END"
    ip = f"array_join(transform(split(form, '[.]'), (c, i) -> cast({octet} as string)), '.')"
    hexed = "CASE WHEN c RLIKE '[0-9]' THEN substring('0123456789', noise[i % 128] % 10 + 1, 1) WHEN c RLIKE '[a-f]' THEN substring('abcdef', noise[i % 128] % 6 + 1, 1) ELSE substring('ABCDEF', noise[i % 128] % 6 + 1, 1) END"
    prefix = "regexp_extract(form, '^(AKIA|gh[opsu]_|sk-|xox[abp]-)', 1)"
    secret = f"CASE WHEN form RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN array_join(transform(split(form, ''), (c, i) -> {hexed}), '') ELSE concat({prefix}, {_masked(f'substring(form, length({prefix}) + 1)', 'noise')}) END"
    masked = _masked("form", "noise")
    # phones keep a leading country code of one digit; cards keep the issuer's digit
    number = f"concat(substring(form, 1, 1), {_masked('substring(form, 2)', 'noise')})"
    body = f"substring({number}, 1, length(form) - 1)"
    check = f"cast((10 - {_luhn(f'concat({body}, 0)')}) % 10 as string)"
    card = f"CASE WHEN {_luhn('form')} = 0 THEN concat({body}, {check}) WHEN {_luhn(number)} = 0 THEN concat({body}, cast((cast(right({number}, 1) as int) + 1) % 10 as string)) ELSE {number} END"
    iban = f"concat(substring(form, 1, 2), {_masked('substring(form, 3)', 'noise')})"
    e = e.withColumn("surrogate", F.expr(f"CASE kind WHEN 'email' THEN {email} WHEN 'ip' THEN {ip} WHEN 'secret' THEN {secret} WHEN 'card' THEN {card} WHEN 'phone' THEN {number} WHEN 'iban' THEN {iban} ELSE {masked} END"))
    name = F.expr(_person_name())
    e = e.withColumn("surrogate", F.when(F.col("kind").startswith("name"), name).otherwise(F.col("surrogate")))
    # out of room: a keyed suffix makes the format longer; invented names get more syllables anyway
    wide = F.expr("array_join(transform(slice(noise, 100, attempt), x -> substring('0123456789', x % 10 + 1, 1)), '')")
    address = F.expr("concat_ws('.', cast(1 + noise[100] % 239 as string), cast(noise[101] as string), cast(noise[102] as string), cast(noise[103] as string))")
    grown = F.when(F.col("kind") == "email", F.concat(wide, "surrogate")).when(F.col("kind").startswith("name"), F.col("surrogate")).when(F.col("kind") == "ip", address).otherwise(F.concat("surrogate", wide))
    return e.withColumn("surrogate", F.when(F.col("attempt") < WIDEN, F.col("surrogate")).otherwise(grown)).select("kind", "form", "attempt", "surrogate")


def _person_name() -> str:
    """SQL: a lower-cased name part of the gender and script that ``kind`` (name:gender:place:script) says."""

    def of(values) -> str:
        return "array(" + ", ".join(f"'{_literal(v.lower())}'" for v in values) + ")"

    place = "(noise[0] * 256 + noise[1])"
    cases = []
    for script in ("latin", "cyrillic"):
        for g in "mf":
            values = GIVEN[g if script == "latin" else f"{g}_cyrillic"]
            cases.append(f"WHEN kind = 'name:{g}:given:{script}' AND attempt < 2 THEN {of(values)}[{place} % {len(values)}]")
        both = (*GIVEN["m"], *GIVEN["f"]) if script == "latin" else (*GIVEN["m_cyrillic"], *GIVEN["f_cyrillic"])
        cases.append(f"WHEN kind = 'name:n:given:{script}' AND attempt < 2 THEN {of(both)}[{place} % {len(both)}]")
        syllables = SYLLABLES[script]
        for g in "mf":
            ends = ENDINGS[g if script == "latin" else f"{g}_cyrillic"]
            cases.append(f"WHEN kind = 'name:{g}:given:{script}' THEN concat(array_join(transform(slice(noise, 3, 1 + attempt div 2), x -> {of(syllables)}[x % {len(syllables)}]), ''), substring('bdgklmnprst', noise[60] % 11 + 1, 1), {of(ends)}[noise[61] % {len(ends)}])" if script == "latin" else f"WHEN kind = 'name:{g}:given:{script}' THEN concat(array_join(transform(slice(noise, 3, 1 + attempt div 2), x -> {of(syllables)}[x % {len(syllables)}]), ''), substring('бгдклмнпрст', noise[60] % 11 + 1, 1), {of(ends)}[noise[61] % {len(ends)}])")
        cases.append(f"WHEN kind LIKE 'name:%:{script}' THEN array_join(transform(slice(noise, 3, 3 + attempt div 3), x -> {of(syllables)}[x % {len(syllables)}]), '')")
    return "CASE " + " ".join(cases) + " ELSE form END"


def _domain() -> Column:
    """Within what surrogates must differ: the type; for names, the script."""
    return F.when(F.col("kind").startswith("name:"), F.concat(F.lit("name:"), F.substring_index("kind", ":", -1))).otherwise(F.col("kind"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, surrogate) for the distinct (kind, form) of ``entities``; surrogates are distinct and no real form.

    Every round settles the entities without a collision; only the others go on, so rounds shrink fast.
    """
    real = written(entities.select("kind", "form").distinct(), "entities")
    forms = real.select(_domain().alias("domain"), F.col("form").alias("surrogate")).distinct()
    left, done = real, None
    for attempt in range(MAX_ATTEMPTS):
        tried = written(_surrogates(left.select("kind", "form").withColumn("attempt", F.lit(attempt)), key).withColumn("domain", _domain()), "attempts")
        owner = tried.groupBy("domain", "surrogate").agg(F.min(F.struct(F.xxhash64("kind", "form"), "kind", "form")).alias("owner")).select("domain", "surrogate", "owner.kind", "owner.form")
        ok = owner.join(forms, ["domain", "surrogate"], "left_anti")
        if done is not None:
            ok = ok.join(done.select("domain", "surrogate"), ["domain", "surrogate"], "left_anti")
        ok = written(ok.select("domain", "kind", "form", "surrogate"), "settled")
        done = ok if done is None else written(done.union(ok), "surrogates")
        left = written(left.join(ok.select("kind", "form"), ["kind", "form"], "left_anti"), "unsettled")
        if left.isEmpty():
            return done.select("kind", "form", "surrogate")
    raise RuntimeError("no distinct surrogates left; use other patterns or a longer format")


def _with_known_gender(mentions: DataFrame) -> DataFrame:
    """``mentions``, written; given names under a neutral title take the gender they have elsewhere."""
    mentions = written(mentions, "mentions")
    gendered = mentions.filter(F.col("kind").rlike("^name:[mf]:given:")).groupBy("form", "kind").count()
    known = gendered.groupBy("form", F.regexp_replace("kind", "^name:[mf]", "name:n").alias("kind")).agg(F.max_by("kind", F.struct("count", (F.col("kind").startswith("name:f")).alias("female"))).alias("known_"))
    return written(mentions.join(known, ["form", "kind"], "left").withColumn("kind", F.coalesce("known_", "kind")).select(mentions.columns), "mentions")


def _mentions(found: DataFrame) -> DataFrame:
    """(row columns, k, kind, form, piece): every entity of a text; persons in parts, one row for each name."""
    each = found.select("id_", "tag_", F.posexplode("entities_").alias("k", "piece")).withColumn("kind", _type_of("piece"))
    plain = each.filter("kind <> 'person'").withColumn("part", F.lit(0)).withColumn("form", _canonical("kind", "piece"))
    title = F.regexp_extract("piece", f"^({_TITLES})[. ]", 1)
    gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("n")
    people = each.filter("kind = 'person'").withColumn("gender", gender).withColumn("names", F.expr("slice(split(piece, ' '), 2, 99)"))
    people = people.select("id_", "tag_", "k", "gender", F.size("names").alias("size"), F.posexplode("names").alias("part", "piece"))
    script = F.when(F.col("piece").rlike("[\\p{IsCyrillic}]"), "cyrillic").otherwise("latin")
    # the last name is the family name, whatever the gender
    kind = F.when(F.col("part") == F.col("size") - 1, F.concat(F.lit("name:any:family:"), script)).otherwise(F.concat(F.lit("name:"), F.col("gender"), F.lit(":given:"), script))
    kind = F.when(F.col("piece").endswith("."), "initial").otherwise(kind)
    people = people.withColumn("kind", kind).withColumn("form", F.lower("piece")).withColumn("part", F.col("part") + 1)
    return plain.select("id_", "tag_", "k", "part", "kind", "form", "piece").union(people.select("id_", "tag_", "k", "part", "kind", "form", "piece"))


def _shaped() -> Column:
    """The surrogate in the format of the mention ``piece``."""
    numbered = "array_join(transform(split(piece, ''), (c, i) -> CASE WHEN c RLIKE '[0-9]' THEN substring(surrogate, length(regexp_replace(substring(piece, 1, i + 1), '[^0-9]', '')), 1) ELSE c END), '')"
    lettered = "array_join(transform(split(piece, ''), (c, i) -> CASE WHEN c RLIKE '[\\\\p{L}0-9]' THEN substring(surrogate, length(regexp_replace(substring(piece, 1, i + 1), '[^\\\\p{L}0-9]', '')), 1) ELSE c END), '')"
    longer = "substring(surrogate, length(form) + 1)"
    mail = "CASE WHEN length(surrogate) = length(piece) AND piece <> lower(piece) THEN array_join(transform(split(surrogate, ''), (c, i) -> CASE WHEN substring(piece, i + 1, 1) RLIKE '\\\\p{Lu}' THEN upper(c) ELSE c END), '') ELSE surrogate END"
    name = "CASE WHEN piece = upper(piece) AND length(piece) > 1 THEN upper(surrogate) ELSE initcap(surrogate) END"
    first = "upper(surrogate)"
    return F.expr(f"CASE WHEN kind IN ('phone', 'card', 'ssn') THEN concat({numbered}, {longer}) WHEN kind = 'iban' THEN concat({lettered}, {longer}) WHEN kind = 'email' THEN {mail} WHEN kind LIKE 'name:%' THEN {name} WHEN kind = 'initial' THEN {first} ELSE surrogate END")


def replace_entities(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the entities of ``text_col`` replaced, and ``n_entities``; ``key`` decides the surrogates."""
    # the other columns travel as one, whatever their names
    rows = df.select(F.struct(*df.columns).alias("row"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_"), F.col(text_col).cast("string").alias("text"))
    text = F.col("text")
    has = F.coalesce(text.rlike(PATTERN), F.lit(False))
    clean = rows.filter(~has).select("row", "text", F.lit(0).alias("n"))
    # the pattern is dear: the rows with entities are written once, with these and the pieces between
    found = rows.filter(has).withColumn("tag_", F.md5(text)).withColumn("entities_", F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).withColumn("pieces_", F.split(text, PATTERN, -1)).drop("text")
    found = written(found, "found")
    mentions = _with_known_gender(_mentions(found.select("id_", "tag_", "entities_").dropDuplicates(["id_", "tag_"])))
    initials = _surrogates(mentions.filter("kind = 'initial'").select("kind", "form", F.lit(0).alias("attempt")).distinct(), key).select("kind", "form", "surrogate")
    surrogate = assign(mentions.filter("kind <> 'initial'"), key).union(initials)
    shaped = mentions.join(surrogate, ["kind", "form"]).withColumn("new", _shaped())
    one = shaped.groupBy("id_", "tag_", "k").agg(F.sort_array(F.collect_list(F.struct("part", "new"))).alias("parts"), F.collect_list(F.when(F.col("kind").startswith("name:"), F.struct("piece", "kind", "new"))).alias("names"))
    one = one.select("id_", "tag_", "names", F.struct("k", F.expr("transform(parts, p -> p.new)").alias("new"), (F.col("parts")[0]["part"] > 0).alias("person")).alias("one"))
    # the mentions of one text; of the surrogates of a name in it, the family name's goes for the name alone
    news = one.groupBy("id_", "tag_").agg(F.sort_array(F.collect_list("one")).alias("news_"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names_"))
    joined = found.join(news, ["id_", "tag_"])
    put = "CASE WHEN news_[i - 1].person THEN concat_ws(' ', split(entities_[i - 1], ' ')[0], array_join(news_[i - 1].new, ' ')) ELSE news_[i - 1].new[0] END"
    # no surrogate is a real name, so one replacement after the other is safe; names hold only letters, apostrophes and hyphens
    bare = f"aggregate(names_, p, (t, x) -> regexp_replace(t, concat('{_literal(_EDGE)}', x.piece, '{_literal(_END)}'), x.new))"
    new_text = F.expr(f"array_join(transform(pieces_, (p, i) -> concat(CASE WHEN i = 0 THEN '' ELSE {put} END, {bare})), '')")
    out = clean.union(joined.select("row", new_text.alias("text"), F.size("entities_").alias("n")))
    names = ("n_entities" + (f"_{i}" if i > 1 else "") for i in range(1, len(df.columns) + 2))
    count = next(n for n in names if n.lower() not in {c.lower() for c in df.columns})
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns], F.col("n").alias(count))
