import re

import pytest
from pyspark.sql import functions as F

from scorespark.llm import pii
from scorespark.llm.pii import entity_table, replace_entities

SCHEMA = "doc_id long, text string, kind string, form string, _doc string"
TEXTS = {
    1: "mail the.72@mail3.example.com or THE.72@MAIL3.example.com now, reeüx.09@mail2.example.com",
    2: 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" and B44E15E09FD311C3CF3163B66D5A9875B883D8CE!!',
    3: "call +1 (017) 555-7713 or +1 017-555-7713, card 4111 1111 1111 1111 and 4111111111111111 or 5927243074273351",
    4: "from 169.122.221.182 to 169.122.221.182. and 10.0.0.1, version 1.2.3 stays 2024 and 12345",
    5: "Mr. John Smith met Mrs Smith and Frau Anna Müller, Господин Иван Петров",
    6: "nothing here",
    7: "",
    8: None,
    9: "the.72@mail3.example.com",
}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "f", "d") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def replaced(spark):
    return {r.doc_id: r for r in replace_entities(frame(spark, TEXTS.items())).collect()}


def test_no_entity_is_left(replaced):
    originals = ["72@mail3", "b44e15", "555-7713", "4111", "59272430", "169.122", "10.0.0.1", "Smith", "Müller", "Петров", "reeüx"]
    for r in replaced.values():
        assert not any(o.lower() in (r.text or "").lower() for o in originals)
    assert {i: r.n_entities for i, r in replaced.items()} == {1: 3, 2: 2, 3: 5, 4: 3, 5: 4, 6: 0, 7: 0, 8: 0, 9: 1}


def test_format_is_kept(replaced):
    shape = lambda t: re.sub("[A-ZÀ-Þ]", "A", re.sub("[a-zß-ÿ]", "a", re.sub(r"\d", "9", t)))
    for i in (1, 3):
        assert shape(replaced[i].text) == shape(TEXTS[i])
    assert all(m.endswith(".com") for m in re.findall(r"\S+@[\w.]+", replaced[1].text))
    assert re.fullmatch(r'token = "[0-9a-f]{40}" and [0-9A-F]{40}!!', replaced[2].text)
    assert replaced[3].text.startswith("call +1 (")
    assert re.fullmatch(r"from [\d.]+ to [\d.]+\. and [\d.]+, version 1\.2\.3 stays 2024 and 12345", replaced[4].text)
    assert replaced[6].text == "nothing here" and replaced[7].text == "" and replaced[8].text is None
    cyrillic = replaced[5].text.split("Господин ")[1]
    assert re.fullmatch("[А-Я][а-я]+ [А-Я][а-я]+", cyrillic)


def test_coreference_and_gender(replaced):
    first, second, _ = re.findall(r"\S+@[\w.]+", replaced[1].text)
    assert first.lower() == second.lower() and second.isupper() is False and second.split("@")[0].isupper()
    assert replaced[9].text == first
    a, b = re.findall(r"[0-9a-fA-F]{40}", replaced[2].text)
    assert a == b.lower()
    one, two = re.findall(r"\+1[ \d()-]+\d", replaced[3].text)
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    x, y = re.findall(r"(?:\d{1,3}\.){3}\d{1,3}", replaced[4].text)[:2]
    assert x == y
    john, wife = re.search(r"Mr\. (\w+ \w+) met Mrs (\w+)", replaced[5].text).groups()
    assert john.split()[1] == wife and john.split()[0] in pii._GIVEN["latin", "male"]
    assert re.search(r"Frau (\w+)", replaced[5].text)[1] in pii._GIVEN["latin", "female"]


def luhn(digits):
    total = 0
    for k, ch in enumerate(reversed(digits)):
        v = int(ch) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10


def test_card_check_digit(replaced):
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"(?:\d{4}[ ]?){3}\d{4}", replaced[3].text)]
    assert cards[0] == cards[1] and luhn(cards[0]) == 0 and cards[0][0] == "4" and cards[2][0] == "5"


def test_clashes_are_drawn_again(spark):
    rows = [(k, f"ip 1.1.{k // 200}.{k % 200} x{k}@a.b Mr K{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100]} end") for k in range(600)]
    docs = frame(spark, rows)
    table = entity_table(docs).cache()
    assert table.count() == table.select("kind", "form").distinct().count() == 1800
    assert table.select("kind", "replacement").distinct().count() == 1800
    assert table.where("attempt > 0").count() > 0
    real = table.select("kind", F.col("form").alias("replacement"))
    assert table.join(real, ["kind", "replacement"]).count() == 0
    lookup = {(r.kind, r.form): r.replacement for r in table.collect()}
    for r in replace_entities(docs).collect():
        ip, mail, person = re.fullmatch(r"ip (\S+) (\S+) (Mr \w+) end", r.text).groups()
        old = re.fullmatch(r"ip (\S+) (\S+) (Mr \w+) end", rows[r.doc_id][1]).groups()
        assert (ip, mail, person) == (lookup["ip", old[0]], lookup["email", old[1]], lookup["person", old[2]])


def test_edge_rows(spark):
    rows = [(None, "a@b.cc"), (1, "a@b.cc"), (1, "a@b.cc"), (2, "x" * 100000 + " a@b.cc " + "9" * 30000)]
    docs = frame(spark, rows)
    out = replace_entities(docs)
    assert out.columns == [*docs.columns, "n_entities"]
    got = out.collect()
    assert [r.n_entities for r in got] == [1, 1, 1, 1] and len({r.text for r in got}) == 2
    assert len([r.text for r in got if r.doc_id == 2][0]) == 130008
    assert replace_entities(docs.limit(0)).count() == 0


def test_another_key_gives_other_surrogates(spark):
    docs = frame(spark, [(1, "a.long.name@host.example.com")])
    texts = {replace_entities(docs, key).first().text for key in ("one", "two")} | {replace_entities(docs, "one").first().text}
    assert len(texts) == 2


@pytest.fixture
def odd(spark):
    rows = {
        1: "محمد@مثال.com", 2: "例え@例え.jp", 3: "_@-.x", 4: "a@b.co c@d.co and a@b.co", 5: "ვანო@ტესტი.ge שלום@דוגמה.il", 6: "%%@--.-",
        7: f"marked {pii.MARK} text mail x.y@z.org and {pii.MARK} end", 8: "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 or DE00 3704 0044 0532 0130 00",
    }
    return rows, {r.doc_id: r for r in replace_entities(frame(spark, rows.items())).collect()}


def test_every_script_and_short_addresses(spark, odd):
    rows, got = odd
    mail = lambda text: re.findall(r"[^\s@]+@[^\s@]+", text)
    for i in (1, 2, 3, 4, 5, 6):
        assert len(mail(rows[i])) == len(mail(got[i].text)) == got[i].n_entities
        assert not set(mail(rows[i])) & set(mail(got[i].text))
    assert re.match("[\u0600-\u06ff]+@[\u0600-\u06ff]+\\.com$", got[1].text)
    assert mail(got[4].text)[0] == mail(got[4].text)[2] != mail(got[4].text)[1]
    assert got[7].text.startswith(f"marked {pii.MARK} text mail ") and got[7].text.endswith(f" and {pii.MARK} end") and got[7].n_entities == 1


def test_a_format_with_few_surrogates_never_ends_the_job(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, f"{a}@{b}.co") for k, (a, b) in enumerate((a, b) for a in letters for b in letters)]  # all there are
    out = {r.doc_id: r.text for r in replace_entities(frame(spark, rows)).collect()}
    assert len(set(out.values())) == len(rows) and not set(out.values()) & {t for _, t in rows}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", t) for t in out.values())


def modulo_97(iban):
    compact = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def test_check_digits_of_accounts(odd):
    found = re.findall(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?(?= or|$)", odd[1][8].text)
    assert [f[:2] for f in found] == ["DE", "GB", "DE"] and [modulo_97(f) == 1 for f in found[:2]] == [True, True]
    assert all(len(f) == len(o) for f, o in zip(found, re.split(" or ", odd[0][8].removeprefix("IBAN "))))


def test_equals_a_plain_rewriting_of_every_text(spark, folder):
    """The texts taken apart by Python's pattern, mentions looked up in the table of surrogates."""
    import regex

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pattern = regex.compile(pii.ENTITY)
    mentions = {m[0] for r in docs.select("text").collect() for m in pattern.finditer(r.text or "")}
    table = spark.createDataFrame([(m,) for m in mentions], "mention string")
    table = table.withColumn("kind", pii.kind_of(F.col("mention"))).withColumn("form", pii.canonical(F.col("mention"), F.col("kind")))
    attempts = entity_table(docs).select("kind", "form", "attempt")
    known = table.join(attempts, ["kind", "form"]).select("mention", pii.surrogate(F.col("mention"), F.col("kind"), F.col("attempt")).alias("new"))
    lookup = {r.mention: r.new for r in known.collect()}
    assert lookup.keys() == mentions and len(mentions) > 10
    want = {r.doc_id: pattern.sub(lambda m: lookup[m[0]], r.text) for r in docs.collect()}
    assert {r.doc_id: r.text for r in replace_entities(docs).collect()} == want
