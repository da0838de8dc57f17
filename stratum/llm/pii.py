"""Keyed surrogates for personal data, with DataFrame functions only.

Entities are found by pattern.  Every different entity of the corpus gets one
surrogate: a keyed function of its kind and normal form, so that it is the same
in all documents (coreference), of the same kind, script, letter case, length
and punctuation, with the same gender for titled names and the same check-digit
state for card numbers.  A surrogate that equals another entity's, or a real
value of the corpus, is drawn again, so different entities stay different; where
a format has too few values, later draws are longer.

Kinds: EMAIL, SECRET (the value after ``password=``, ``token = `` and the like),
KEY (access keys known by their prefix, which stays), PHONE, CARD, SSN, IPV4,
IBAN (without recomputed check digits), PERSON_M, PERSON_F and PERSON_N (names
after a title; N: after one without gender).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh, materialize
from stratum.session import scratch_path

KEY = "stratum surrogates"
#: Draws of a surrogate until none is equal to another; those after ``SAME``
#: add a letter or digit each, so that there is always a free one.
ROUNDS = 64
SAME = 8

# Titles and given names by gender (and script).
TITLES_M = "Mr|Herr|Monsieur|Señor|г-н"
TITLES_F = "Mrs|Miss|Ms|Frau|Madame|Mme|Señora|г-жа"
TITLES_N = "Dr|Prof"
TITLES = f"{TITLES_M}|{TITLES_F}|{TITLES_N}"
GIVEN = {
    ("M", "latin"): "Adam Bruno Carl David Emil Felix Georg Henry Ivan Jonas Karl Louis Martin Noel Oscar Paul",
    ("F", "latin"): "Alice Bella Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula",
    ("M", "cyrillic"): "Антон Борис Виктор Глеб Денис Иван Кирилл Лев Марк Никита Олег Павел",
    ("F", "cyrillic"): "Алла Вера Галина Дарья Елена Зоя Ирина Лидия Марина Нина Ольга Софья",
    ("M", "greek"): "Αλέξης Γιάννης Δημήτρης Κώστας Λουκάς Μάριος Νίκος Πέτρος",
    ("F", "greek"): "Άννα Βάσω Δάφνη Ελένη Κατερίνα Μαρία Νίκη Σοφία",
}
#: By script, the letters that replace its letters: vowels, consonants (scripts
#: without the distinction have all in both).
LETTERS = {"latin": ("aeiou", "bcdfghklmnprstvz"), "cyrillic": ("аеиоу", "бвгдзклмнпрст"),
           "greek": ("αειου", "βγδζκλμνπρστ"), "armenian": ("աեէըիոօ", "բգդզթժլխկհձղմյնշչպջռսվտր"),
           "georgian": ("აეიოუ", "ბგდვზთკლმნპრსტ"), "hebrew": ("אבגדהוזחטילמנסעפצקרשת",) * 2,
           "arabic": ("ابتثجحخدذرزسشصضطعفقكلمنهوي",) * 2, "devanagari": ("कखगघचछजझटठडढतथदधनपफबभमयरलवशसह",) * 2,
           "thai": ("กขคงจชซดตถทนบปผพฟมยรลวสหอ",) * 2, "hiragana": ("あいうえおかきくけこさしすせそたちつてとなにぬねの",) * 2,
           "katakana": ("アイウエオカキクケコサシスセソタチツテトナニヌネノ",) * 2, "hangul": ("가나다라마바사아자차카타파하고노도로모보소오",) * 2,
           "han": ("王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗",) * 2}
HEARD = {"latin": "[aeiouyà-æè-ïò-öø-ýāăąēĕėęěĩīĭįıōŏőœũūŭůűų]", "cyrillic": "[аеёиоуыэюя]",
         "greek": "[αειουηωάέίόύήώ]", "armenian": "[աեէըիոօ]", "georgian": "[აეიოუ]"}

GIVEN |= {("N", script): f"{GIVEN['M', script]} {GIVEN['F', script]}" for script in ("latin", "cyrillic", "greek")}

_NAME = r"\p{Lu}[\p{L}\p{M}'’-]++"
# Values are open-ended; of one without quotes, punctuation at its end stays outside.
_END = r".,;:!?)\]}>\"'"
_HEAD = (r"(?i:(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key))"
         r"[\"']?\s{0,3}[=:]\s{0,3}")
SECRET = _HEAD + (r"(?:\"(?=[^\s\p{Z}\"]*?[\p{L}\p{Nd}])[^\s\p{Z}\"]{8,}+\"?"
                  r"|'(?=[^\s\p{Z}']*?[\p{L}\p{Nd}])[^\s\p{Z}']{8,}+'?"
                  r"|(?![\"'])(?=[^\s\p{Z}]{8})(?=[^\s\p{Z}]*?[\p{L}\p{Nd}])"
                  rf"(?:[^\s\p{{Z}}{_END}]++|[{_END}]++(?=[^\s\p{{Z}}{_END}]))++)")
KEYS = (r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsru]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9_-]{20,}+)"
        r"(?![A-Za-z0-9])")
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\w.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)"
PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})[ .-]?\d{2,4}(?:[.-]\d{2,4}){1,3}(?!\d)"
         r"|(?<![\w+])\+\d{1,3} ?(?:\(\d{1,4}\)|\d{1,4})(?: ?\d{2,4}){1,4}(?!\d)"
         r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])")
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# Possessive: a long row of titles neither recurses nor is tried again; a match starts at the row's first title.
_TITLES = rf"(?:(?:{TITLES})\.? )++"
PERSON = rf"(?<!\p{{L}})(?=(?:{TITLES})\.? )(?<!(?<!\p{{L}})(?:{TITLES})\.? ){_TITLES}{_NAME}(?: {_NAME})*+"
PATTERN = "|".join([SECRET, KEYS, EMAIL, IPV4, SSN, CARD, PHONE, IBAN, PERSON])


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found(text: str) -> Column:
    """Array of the entities of a text, in order."""
    return F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))


def _parts(hit: Column) -> Column:
    """An entity as (kind, prefix, core, suffix, norm)."""
    titles = F.regexp_extract(hit, f"^({_TITLES})", 1)
    kind = (F.when(hit.rlike(f"^{_HEAD}"), "SECRET")
            .when(hit.contains("@"), "EMAIL")
            .when(titles.rlike(rf"(?:^| )(?:{TITLES_M})\.? "), "PERSON_M")
            .when(titles.rlike(rf"(?:^| )(?:{TITLES_F})\.? "), "PERSON_F")
            .when(titles != "", "PERSON_N")
            .when(hit.rlike(f"^(?:{KEYS})$"), "KEY")
            .when(hit.rlike(f"^(?:{IPV4})$"), "IPV4")
            .when(hit.rlike(f"^(?:{SSN})$"), "SSN")
            .when(hit.rlike(f"^(?:{CARD})$"), "CARD")
            .when(hit.rlike(f"^(?:{PHONE})$"), "PHONE").otherwise("IBAN"))
    cut = F.when(kind == "SECRET", F.regexp_extract(hit, r"^(.*?[=:]\s{0,3}[\"']?)", 1)).when(
        kind.startswith("PERSON"), titles).otherwise("")
    rest = F.substr(hit, F.length(cut) + 1)
    core = F.when(kind == "SECRET", F.regexp_replace(rest, r"[\"']$", "")).otherwise(rest)
    norm = (F.when(kind == "EMAIL", F.lower(core))
            .when(kind.isin("PHONE", "CARD", "SSN"), F.regexp_replace(core, r"[^0-9]", "")).otherwise(core))
    return F.struct(kind.alias("kind"), cut.alias("prefix"), core.alias("core"),
                    F.substr(rest, F.length(core) + 1).alias("suffix"), norm.alias("norm"))


def _number(seed: str, i: str) -> str:
    """SQL: a keyed number below 2**28 for place ``i``."""
    return f"cast(conv(substr(sha2(concat({seed}, ':', {i}), 256), 1, 7), 16, 10) AS int)"


def _from(letters: str, number: str) -> str:
    return f"substr({_lit(letters)}, {number} % {len(letters)} + 1, 1)"


def _classes(text: str, seed: str, more: str = "") -> str:
    """SQL: every ASCII letter or digit replaced by one of its class, others as
    by the cases ``more``."""
    n = _number(seed, "i")
    return f"""array_join(transform(split({text}, ''), (c, i) -> CASE
        WHEN c BETWEEN '0' AND '9' THEN {_from("0123456789", n)}
        WHEN c BETWEEN 'a' AND 'z' THEN {_from("abcdefghijklmnopqrstuvwxyz", n)}
        WHEN c BETWEEN 'A' AND 'Z' THEN {_from("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n)}
        {more} ELSE c END), '')"""


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum modulo 10."""
    return f"""aggregate(transform(split(reverse({digits}), ''), (c, i) ->
        CASE WHEN i % 2 = 0 THEN cast(c AS int) ELSE cast(c AS int) * 2 - if(c > '4', 9, 0) END), 0, (a, x) -> a + x) % 10"""


def _letters(n: str) -> str:
    """SQL: the cases that replace a letter or digit ``c``, vowels by vowels,
    in its script and letter case; a script without letters here gets Latin
    ones."""
    cases = []
    for script, (vowels, consonants) in LETTERS.items():
        letters = _lit(consonants)
        if script in HEARD:
            letters = f"if(lower(c) RLIKE {_lit(HEARD[script])}, {_lit(vowels)}, {letters})"
        cases.append(f"WHEN c RLIKE {_lit(rf'\p{{Is{script.capitalize()}}}')} THEN {letters}")
    alphabet = f"CASE {' '.join(cases)} ELSE {_lit(''.join(LETTERS['latin']))} END"
    new = f"substr({alphabet}, {n} % length({alphabet}) + 1, 1)"
    return (f"WHEN c RLIKE {_lit(r'\p{L}')} THEN if(c = lower(c), {new}, upper({new})) "
            f"WHEN c RLIKE {_lit(r'\p{Nd}')} THEN {_from('0123456789', n)}")


def _family(text: str, seed: str) -> str:
    """SQL: a name's letters replaced."""
    return f"array_join(transform(split({text}, ''), (c, i) -> CASE {_letters(_number(seed, 'i'))} ELSE c END), '')"


def _given(gender: str) -> str:
    """SQL: for name ``g``, a given name of the same script and case; in scripts
    without given names here, its letters replaced."""
    cases = []
    for script, test in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"), ("latin", r"\p{IsLatin}")):
        names = GIVEN[gender, script].split()
        pick = f"element_at(array({', '.join(map(_lit, names))}), {_number('seed0', 'g')} % {len(names)} + 1)"
        cases.append(f"WHEN g RLIKE {_lit(test)} THEN {pick}")
    pick = f"CASE {' '.join(cases)} ELSE {_family('g', 'concat(seed0, g)')} END"
    return f"if(g = upper(g), upper({pick}), {pick})"


#: SQL: the host of an e-mail address, without its last label.
HOST = "regexp_replace(substring_index(norm, '@', -1), '[.][^.]*$', '')"


def _surrogate(round_no: int, key: str) -> Column:
    """The surrogate of (kind, norm) in this draw.  ``seed0`` (the key and kind
    alone) serves parts that stay the same in all entities that have them."""
    seed0 = f"concat({_lit(key)}, '|', kind)"
    seed = f"concat({seed0}, '|', digest, '|', '{round_no}')"
    again = "''" if round_no == 0 else f"concat('|', digest, '|', '{round_no}')"  # else one family, one surrogate
    more = max(0, round_no + 1 - SAME)

    def longer(text: str, by: str) -> str:
        return f"concat({text}, repeat({by}, {more}))" if more else text

    family = "element_at(split(norm, ' '), -1)"
    person = "concat_ws(' ', transform(slice(split(norm, ' '), 1, size(split(norm, ' ')) - 1), g -> {0}), {1})"
    last = f"concat({_lit(key)}, '|family|', part, {again})"
    initial = f"if({family} = upper({family}), left({family}, 1), lower(left({family}, 1)))"
    names = {g: person.format(_given(g).replace("seed0", seed0), _family(longer(family, initial), last)) for g in "MFN"}
    secret = longer("norm", "'a'")
    hexa = "array_join(transform(split({1}, ''), (c, i) -> {0}), '')".format(
        _from("0123456789abcdef", _number(seed, "i")), secret)
    top = "regexp_extract(norm, '([.][^.@]*)$', 1)"
    email = (f"concat({_classes(longer(chr(39).join(['substring_index(norm, ', '@', ', 1)']), chr(39) + 'a' + chr(39)), seed)}, '@', "
             f"{_classes(HOST, f'concat({seed0}, {chr(39)}|{chr(39)}, part)')}, {top})")
    middle = longer("substr(norm, 2, length(norm) - 2)", "'0'")
    body = f"concat(substr(norm, 1, 1), {_classes(middle, seed)})"
    # the last digit restores the Luhn sum of the original
    card = f"concat({body}, cast(pmod({_luhn('norm')} - {_luhn(f'concat({body}, {chr(39)}0{chr(39)})')}, 10) AS string))"
    ip = (f"concat_ws('.', transform(split({longer('norm', chr(39) + '.0' + chr(39))}, '[.]'), "
          f"(o, i) -> cast({_number(seed, 'i')} % 254 + 1 AS string)))")
    digits = longer("norm", "'0'")
    return F.expr(f"""CASE kind
        WHEN 'EMAIL' THEN {email}
        WHEN 'SECRET' THEN if(norm RLIKE '^[0-9a-f]+$', {hexa}, {_classes(secret, seed, _letters(_number(seed, "i")))})
        WHEN 'CARD' THEN {card}
        WHEN 'IPV4' THEN {ip}
        WHEN 'PHONE' THEN concat(substr(norm, 1, 1), {_classes(f"substr({digits}, 2)", seed)})
        WHEN 'KEY' THEN concat(substr(norm, 1, 4), {_classes(f"substr({digits}, 5)", seed)})
        WHEN 'IBAN' THEN concat(substr(norm, 1, 2), {_classes(f"substr({digits}, 3)", seed)})
        WHEN 'PERSON_M' THEN {names["M"]}
        WHEN 'PERSON_F' THEN {names["F"]}
        WHEN 'PERSON_N' THEN {names["N"]}
        ELSE {_classes(digits, seed)} END""")


def surrogates(spark: SparkSession, entities: DataFrame, key: str = KEY) -> DataFrame:
    """Different (kind, norm) -> (kind, norm, surrogate), one-to-one within a
    kind and never equal to a norm of ``entities``.

    Each draw keeps, of equal surrogates, that of the least norm; the others
    are drawn again with the next number, from ``SAME`` draws on with one letter
    or digit more each time.  Raises if entities are left after ``ROUNDS`` draws.
    """
    # seeds of a fixed length, hashed once: a letter of a long entity costs no more than one of a short
    entities = materialize(spark, entities.select(
        "kind", "norm", F.sha2("norm", 256).alias("digest"),
        F.expr(f"sha2(if(kind = 'EMAIL', {HOST}, lower(element_at(split(norm, ' '), -1))), 256)").alias("part")),
        "pii-entities")
    kept = scratch_path(spark, "pii-surrogates")
    schema = "kind string, norm string, surrogate string"
    pending = entities
    for n in range(ROUNDS):
        drawn = materialize(spark, pending.withColumn("surrogate", _surrogate(n, key)), "pii-drawn")
        taken = entities.select("kind", F.col("norm").alias("surrogate"))
        if n:
            taken = taken.unionByName(spark.read.schema(schema).parquet(f"{kept}/*").select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        won.select("kind", "norm", "surrogate").write.parquet(f"{kept}/draw={n}")
        got = spark.read.schema(schema).parquet(f"{kept}/draw={n}")
        pending = materialize(spark, drawn.join(got, ["kind", "norm"], "left_anti").select(*entities.columns),
                              "pii-pending")
        if pending.isEmpty():
            return spark.read.schema(schema).parquet(f"{kept}/*")
    raise RuntimeError(f"entities without a surrogate of their own after {ROUNDS} draws")


def _shaped() -> Column:
    """The surrogate in the occurrence's punctuation."""
    spread = F.expr("""array_join(zip_with(split(core, '[0-9]'), split(surrogate, ''),
        (s, d) -> concat(coalesce(s, ''), coalesce(d, ''))), '')""")
    digits = F.col("kind").isin("PHONE", "CARD", "SSN")
    return F.concat("prefix", F.when(digits, spread).otherwise(F.col("surrogate")), "suffix")


def replace(spark: SparkSession, docs: DataFrame, key: str = KEY, text: str = "text",
            count: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced by its surrogate; all
    rows and columns stay.  ``count``: name of an added column with the number
    of replaced entities.

    Null and empty texts stay as they are; repeated rows are replaced alike;
    other columns are not looked at, whatever their names.  The entity table
    and the occurrences are shuffled, texts only where they hold an entity;
    a frequent entity is one side of an equi-join that AQE splits.
    """
    uid, n = fresh(docs, "uid"), count or fresh(docs, "entities")
    has = F.coalesce(F.col(text).rlike(PATTERN), F.lit(False))
    hits = materialize(spark, docs.where(has).withColumn(uid, F.monotonically_increasing_id()), "pii-hits")
    spots = (hits.select(F.col(uid).alias("uid"), F.posexplode(found(text)).alias("pos", "hit"))
             .select("uid", "pos", _parts(F.col("hit")).alias("p")).select("uid", "pos", "p.*"))
    spots = materialize(spark, spots, "pii-spots")
    named = surrogates(spark, spots.select("kind", "norm").distinct(), key)
    by_doc = (spots.join(named, ["kind", "norm"]).select("uid", F.struct("pos", _shaped().alias("s")).alias("x"))
              .groupBy("uid").agg(F.array_sort(F.collect_list("x")).alias("xs")))
    by_doc = by_doc.select(F.col("uid").alias(uid), F.col("xs.s").alias(fresh(docs, "new")))
    new = fresh(docs, "new")
    joined = hits.join(by_doc, uid)
    rebuilt = F.array_join(F.zip_with(F.split(F.col(text), PATTERN, -1), F.col(new),
                                      lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    done = joined.select(*[rebuilt.alias(c) if c == text else F.col(c) for c in docs.columns],
                         F.size(new).cast("long").alias(n))
    out = docs.where(~has).withColumn(n, F.lit(0).cast("long")).unionByName(done)
    return out if count else out.drop(n)
