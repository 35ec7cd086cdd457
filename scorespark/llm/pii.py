"""Surrogates for personal data: keyed, type-consistent replacements, checked for collisions.

Everything is DataFrame expressions. One pattern finds entities of all kinds; a
text is the pieces between them and the entities, so whole texts are rewritten in
their own row and only entities are shuffled.

* A mention has a canonical form (case, separators and titles aside). Surrogates
  are a function of key, kind, canonical form and attempt, so all mentions of an
  entity in any document get the same one, in the format of the mention: letters
  stay letters of their case and script, digits digits, separators stay; phone
  numbers keep the country code, card numbers their first digit and whether they
  pass the Luhn check, addresses are valid octets, e-mail addresses keep the
  top-level domain; names follow the gender of the title and the script.
* The distinct entities are checked: no two of a kind share a surrogate and no
  surrogate is an entity of the corpus. Those that do are drawn again
  (next attempt), all but the smallest of each clash. Only entities beyond the
  first attempt are looked up when texts are rewritten.
* Short formats have few surrogates, and a mention may hold no letter or digit that
  could be drawn. From attempt ``PLAIN`` on surrogates are therefore longer than the
  mention, by one keyed letter (e-mail) or digit more with each attempt, so
  every clash ends, whatever the corpus holds.

Mentions are found by one pass over the texts, which are written down with the mentions marked.

Null text stays null and has no entities; empty texts stay empty. Repeated rows are
treated alike. Other columns pass through; ``n_entities`` replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.session import stage

KEY = "change-me"
#: Attempts that keep the length of the mention.
PLAIN = 4
#: Marks mentions in a text; texts that hold it themselves are taken apart by the pattern instead.
MARK = "\u0001"
#: Rows (of a few dozen bytes) up to which the table of repeated draws is broadcast.
BROADCAST_ROWS = 4_000

_TITLES_MALE = "Mr|Mister|Herr|Monsieur|Señor|Sr|Господин"
_TITLES_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Госпожа"
_TITLES_OTHER = "Dr|Prof"
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"

#: Kinds in the order in which they claim a stretch of text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": _BEFORE + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:sk|pk|ghp|gho|xoxb|xoxp|AKIA)[-_]?[A-Za-z0-9]{16,64})" + _AFTER,
    "iban": _BEFORE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _AFTER,
    "card": _BEFORE + r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}" + _AFTER,
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{L}\p{N}]|\.[0-9])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _AFTER,
    "number": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "person": rf"{_BEFORE}(?:{_TITLES_MALE}|{_TITLES_FEMALE}|{_TITLES_OTHER})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?{_AFTER}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())

_ALPHABETS = (
    (r"[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    (r"[àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß]", "àáâäçèéêëìíîïñòóôöùúûü"),
    (r"[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"[а-яё]", "абвгдежзийклмнопрстуфхцчшщыьэюя"),
    (r"\p{IsArmenian}", "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ"),
    (r"\p{IsGeorgian}", "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"),
    (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (r"\p{IsDevanagari}", "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह"),
    (r"\p{IsBengali}", "কখগঘচছজঝটঠডঢণতথদধনপফবভমযরলশষসহ"),
    (r"\p{IsTamil}", "கஙசஞடணதநபமயரலவழளறன"),
    (r"\p{IsThai}", "กขคงจฉชซญฐฒณดตถทธนบปผฝพฟภมยรลวศษสหอฮ"),
    (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ"),
    (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허고노도로모보소오조초코토포호"),
    (r"\p{IsHan}", "一三上下中人今你元光入全公出力北千午南友古右名后向品四土坐城大天太女好子安家富小山左平年心手文日明春星月木本正水江河火父生白百目石社秋空立竹米花草行西言車金長門雨青風高"),
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),  # letters of all other scripts
)
_GIVEN = {
    ("latin", "male"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Henry", "Ivan", "Jonas", "Karl", "Louis", "Martin", "Noel", "Oscar", "Peter"),
    ("latin", "female"): ("Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("cyrillic", "male"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл"),
    ("cyrillic", "female"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
}
_SYLLABLES = {
    "latin": ("ba", "be", "da", "do", "fa", "ga", "ha", "ka", "la", "le", "lo", "ma", "mi", "na", "ne", "no", "pa", "ra", "ri", "ro", "sa", "se", "ta", "te", "to", "va", "ve", "vi", "wa", "za"),
    "cyrillic": ("ба", "ве", "га", "до", "жа", "зи", "ка", "ло", "ми", "на", "пе", "ро", "са", "ти", "фа", "че"),
}


def kind_of(mention: Column) -> Column:
    out = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k != "person"]):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def canonical(mention: Column, kind: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    country = F.regexp_extract(mention, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    phone = F.when(F.length(country) > 0, F.concat(F.lit("+"), country, F.lit(" "), F.substr(digits, F.length(country) + 1))).otherwise(
        F.concat(F.regexp_extract(mention, r"^\+?", 0), digits)
    )
    compact = F.regexp_replace(mention, " ", "")
    return (
        F.when(kind.isin("email", "secret"), F.lower(mention))
        .when(kind == "iban", compact)
        .when(kind.isin("card", "number"), digits)
        .when(kind == "phone", phone)
        .otherwise(mention)
    )


def _pick(options, key: Column) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(key, F.lit(len(options))).cast("int"))


def _letter(ch: Column, key: Column) -> Column:
    """A keyed letter of the script and case of ``ch``; other characters stay."""
    low = F.lower(ch)
    out = ch
    for pattern, alphabet in reversed(_ALPHABETS):
        drawn = F.substr(F.lit(alphabet), (F.pmod(key, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
        out = F.when(low.rlike(f"^{pattern}$"), F.when(ch == low, drawn).otherwise(F.upper(drawn))).otherwise(out)
    return out


def _redrawn(mention: Column, seed: Column, keep: Column, hexadecimal: Column, until: Column) -> Column:
    """``mention`` with letters and digits drawn anew but for the first ``keep`` and from place ``until`` on."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"), F.lit(0).alias("at"))

    def step(state: Column, ch: Column) -> Column:
        key = F.xxhash64(seed, state["n"])
        alnum = ch.rlike(r"^[\p{L}\p{N}]$")
        hex_letter = F.substr(F.lit("abcdef"), (F.pmod(key, F.lit(6)) + 1).cast("int"), F.lit(1))
        drawn = (
            F.when(ch.rlike("^[0-9]$"), F.pmod(key, F.lit(10)).cast("string"))
            .when(hexadecimal, F.when(ch.rlike("^[A-Z]$"), F.upper(hex_letter)).otherwise(hex_letter))
            .otherwise(_letter(ch, key))
        )
        new = F.when(alnum & (state["n"] >= keep) & (state["at"] < until), drawn).otherwise(ch)
        return F.struct(
            F.concat(state["out"], new).alias("out"), (state["n"] + alnum.cast("int")).alias("n"), (state["at"] + 1).alias("at")
        )

    return F.aggregate(F.split(mention, ""), start, step, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10; 0 for valid numbers."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda ch, i: F.when(i % 2 == 1, ch.cast("int") * 2).otherwise(ch.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10


def _with_check_digit(card: Column, mention: Column) -> Column:
    digits = F.regexp_replace(card, "[^0-9]", "")
    valid = _luhn(F.regexp_replace(mention, "[^0-9]", "")) == 0
    last = F.right(digits, F.lit(1)).cast("int")
    fixed = F.concat(F.left(card, F.length(card) - 1), F.pmod(last - _luhn(digits), F.lit(10)).cast("string"))
    return F.when(valid, fixed).otherwise(card)


def _modulo_97(text: Column) -> Column:
    """Digits and capitals (A is 10, Z is 35) read as one number, modulo 97."""

    def step(rest: Column, ch: Column) -> Column:
        value = F.when(ch.rlike("^[0-9]$"), ch.cast("int")).otherwise(F.ascii(ch) - 55)
        return F.when(value < 10, (rest * 10 + value) % 97).otherwise((rest * 100 + value) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _with_check_digits(iban: Column, mention: Column) -> Column:
    """``iban`` with the check digits of its letters and digits, if those of ``mention`` are right."""

    def turned(text: Column, digits: Column) -> Column:
        compact = F.regexp_replace(text, " ", "")
        return F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(2)), digits)

    right = _modulo_97(turned(mention, F.substr(mention, F.lit(3), F.lit(2)))) == 1
    check = F.lpad((98 - _modulo_97(turned(iban, F.lit("00")))).cast("string"), 2, "0")
    return F.when(right, F.concat(F.left(iban, F.lit(2)), check, F.substr(iban, F.lit(5)))).otherwise(iban)


def _lengthened(drawn: Column, mention: Column, kind: Column, seed: Column, attempt: Column) -> Column:
    """From attempt PLAIN on, one keyed letter or digit more with each attempt: no format is too short for long."""
    more = F.greatest(F.lit(0), attempt - (PLAIN - 1))
    places = F.when(more > 0, F.sequence(F.lit(1), F.greatest(more, F.lit(1)))).otherwise(F.array().cast("array<int>"))

    def keyed(options: str) -> Column:
        pick = lambda k: F.substr(F.lit(options), (F.pmod(F.xxhash64(seed, F.lit("more"), k), F.lit(len(options))) + 1).cast("int"), F.lit(1))
        return F.array_join(F.transform(places, pick), "")

    letters = keyed("abcdefghijklmnopqrstuvwxyz")
    cased = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(letters)).otherwise(letters)
    return F.when(kind == "email", F.concat(cased, drawn)).when(kind.isin("ip", "person"), drawn).otherwise(F.concat(drawn, keyed("0123456789")))


def _person(mention: Column, seed_base: Column, attempt: Column) -> Column:
    """Title as it stands, keyed given name of its gender, keyed surname; surnames alone agree with full names."""
    title = F.regexp_extract(mention, r"^\S+", 0)
    names = F.split(F.regexp_replace(mention, r"^\S+ ", ""), " ")
    surname, given = F.element_at(names, -1), F.element_at(names, 1)
    cyrillic = surname.rlike(r"\p{IsCyrillic}")
    female = title.rlike(rf"^(?:{_TITLES_FEMALE})\.?$")
    male = title.rlike(rf"^(?:{_TITLES_MALE})\.?$")
    own = F.xxhash64(seed_base, F.lower(given), attempt)
    woman = female | (~male & (F.pmod(own, F.lit(2)) == 0))

    def of(script: str) -> tuple[Column, Column]:
        first = F.when(woman, _pick(_GIVEN[script, "female"], own)).otherwise(_pick(_GIVEN[script, "male"], own))
        parts = F.transform(F.sequence(F.lit(1), F.lit(3) + attempt), lambda k: _pick(_SYLLABLES[script], F.xxhash64(seed_base, F.lower(surname), k, attempt)))
        return first, F.initcap(F.array_join(parts, ""))

    latin, other = of("latin"), of("cyrillic")
    first, last = F.when(cyrillic, other[0]).otherwise(latin[0]), F.when(cyrillic, other[1]).otherwise(latin[1])
    return F.concat_ws(" ", title, F.when(F.size(names) > 1, first), last)


def surrogate(mention: Column, kind: Column, attempt: Column, key: str = KEY) -> Column:
    """Replacement of a mention; the same function of its canonical form for all mentions of an entity."""
    given = F.struct(mention.alias("m"), kind.alias("k"), attempt.cast("int").alias("a"))
    parts = lambda e: [F.lit(key), e["k"], canonical(e["m"], e["k"]), e["a"].cast("string")]
    seeded = lambda e: F.sha2(F.concat_ws("\u0000", *parts(e)).cast("binary"), 256)
    return _let(given, lambda e: _let(seeded(e), lambda seed: _let(_drawn(e, seed), lambda drawn: _formed(e, seed, drawn, key))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _drawn(e: Column, seed: Column) -> Column:
    mention, kind = e["m"], e["k"]
    country = F.length(F.regexp_extract(mention, r"^\+([0-9]{1,3})(?=[ .(-])", 1))
    keep = F.when(kind == "phone", country).when(kind == "card", F.lit(1)).when(kind == "iban", F.lit(2)).otherwise(F.lit(0))
    until = F.when(kind == "email", F.length(mention) - F.length(F.regexp_extract(mention, r"\.[^.]*$", 0))).otherwise(F.length(mention))
    return _redrawn(mention, seed, keep, (kind == "secret") & mention.rlike("^[0-9A-Fa-f]+$"), until)


def _formed(e: Column, seed: Column, drawn: Column, key: str) -> Column:
    mention, kind, attempt = e["m"], e["k"], e["a"]
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: (F.pmod(F.xxhash64(seed, k), F.lit(223)) + 1).cast("string"))
    of_kind = F.sha2(F.concat(F.lit(key + "\u0000"), kind).cast("binary"), 256)
    return (
        F.when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "person", _let(of_kind, lambda base: _person(mention, base, attempt)))
        .when(attempt >= PLAIN, _lengthened(drawn, mention, kind, seed, attempt))
        .when(kind == "card", _with_check_digit(drawn, mention))
        .when(kind == "iban", _with_check_digits(drawn, mention))
        .otherwise(drawn)
    )


def _taken_apart(text: Column) -> Column:
    """Text and mentions in turn, text first and last; null for null."""
    marked = F.split(F.regexp_replace(text, f"(?:{ENTITY})", f"{MARK}$0{MARK}"), MARK, -1)
    mentions = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    pieces = F.zip_with(F.split(text, ENTITY, -1), mentions, lambda p, m: F.array(p, m))
    slowly = F.flatten(pieces)
    slowly = F.slice(slowly, F.lit(1), F.size(slowly) - 1)  # the last piece has no mention behind it
    return F.when(F.contains(text, F.lit(MARK)), slowly).otherwise(marked)


def _mentions_of(parts: Column) -> Column:
    return F.coalesce(F.filter(parts, lambda p, k: k % 2 == 1), F.array().cast("array<string>"))


def _marked(docs: DataFrame) -> DataFrame:
    """The rows without their text, written with the parts of the text."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others, F.lit(True).alias("_")).alias("_doc"), _taken_apart(F.col("text")).alias("_parts"))
    return stage(rows, "pii-marked")


def _identity(mention: Column, kind: Column) -> Column:
    """Canonical form, for persons without the title."""
    form = canonical(mention, kind)
    return F.when(kind == "person", F.lower(F.regexp_replace(form, r"^\S+ ", ""))).otherwise(form)


def entity_table(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, form, attempt, replacement) of every distinct entity, without clashes.

    ``form`` is a mention in canonical form, for persons the smallest title and name.
    """
    return _entities(_marked(docs), key)


def _entities(marked: DataFrame, key: str) -> DataFrame:
    spark = marked.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = marked.select(F.explode(_mentions_of(F.col("_parts"))).alias("mention")).distinct()
    kinds = found.withColumn("kind", kind_of(F.col("mention")))
    forms = kinds.select("kind", canonical(F.col("mention"), F.col("kind")).alias("form"), F.lit(0).alias("attempt")).distinct()
    forms = stage(forms, "pii-forms")
    while True:
        # surrogates are drawn in many tasks, however small the written table of forms is
        dealt = forms.repartition(tasks, "kind", "form")
        drawn = stage(
            dealt.withColumn("replacement", surrogate(F.col("form"), F.col("kind"), F.col("attempt"), key)).withColumns(
                {"identity": _identity(F.col("form"), F.col("kind")), "new_identity": _identity(F.col("replacement"), F.col("kind"))}
            ),
            "pii-drawn",
        )
        groups = drawn.groupBy("kind", "new_identity").agg(F.min("identity").alias("_first"), F.max("identity").alias("_last"))
        shared = groups.where("_first < _last").select("kind", "new_identity", "_first")
        real = drawn.select("kind", F.col("identity").alias("new_identity"), F.lit(True).alias("_real")).distinct()
        clashes = drawn.join(shared, ["kind", "new_identity"], "left").join(real, ["kind", "new_identity"], "left")
        again = F.coalesce(F.col("identity") > F.col("_first"), F.lit(False)) | F.coalesce("_real", F.lit(False))
        forms = stage(
            clashes.select("kind", "form", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")), "pii-forms"
        )
        if forms.where("again").isEmpty():
            return drawn.select("kind", "form", "attempt", "replacement")
        forms = forms.drop("again")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with entities replaced in ``text``, and ``n_entities``."""
    marked = _marked(docs)
    table = _entities(marked, key)
    redrawn = stage(table.where("attempt > 0").select("kind", "form", "attempt"), "pii-redrawn")
    rows = marked.withColumn("_mentions", _mentions_of(F.col("_parts")))
    attempts = F.transform("_mentions", lambda m: F.lit(0))
    repeats = redrawn.count()
    if repeats:
        rows = rows.withColumn("_row", F.xxhash64("_mentions"))  # rows with the same mentions get the same surrogates
        small = F.broadcast(redrawn) if repeats <= BROADCAST_ROWS else redrawn
        every = rows.where(F.size("_mentions") > 0).select("_row", F.posexplode("_mentions").alias("place", "mention"))
        every = every.withColumn("kind", kind_of(F.col("mention")))
        every = every.withColumn("form", canonical(F.col("mention"), F.col("kind")))
        listed = every.join(small, ["kind", "form"]).select(F.col("_row").alias("_listed"), "place", "attempt").distinct()
        listed = listed.groupBy("_listed").agg(F.map_from_entries(F.collect_list(F.struct("place", "attempt"))).alias("_attempts"))
        listed = stage(listed, "pii-listed")
        rows = rows.join(F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed, F.col("_row") == F.col("_listed"), "left")
        attempts = F.transform(
            "_mentions", lambda m, i: F.coalesce(F.try_element_at(F.col("_attempts"), i), F.lit(0))
        )
    replaced = F.transform(
        F.arrays_zip(F.col("_mentions").alias("m"), attempts.alias("a")), lambda x: surrogate(x["m"], kind_of(x["m"]), x["a"], key)
    )
    plain = F.filter("_parts", lambda p, k: k % 2 == 0)  # one more than there are mentions
    pairs = F.arrays_zip(plain.alias("p"), F.concat(replaced, F.array(F.lit(""))).alias("r"))
    joined = F.array_join(F.flatten(F.transform(pairs, lambda x: F.array(x["p"], x["r"]))), "")
    new_text = F.when(F.size("_mentions") > 0, joined).otherwise(F.get("_parts", F.lit(0)))
    kept = [new_text.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in docs.columns if c != "n_entities"]
    return rows.select(*kept, F.size("_mentions").cast("long").alias("n_entities"))
