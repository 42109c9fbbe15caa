"""Pseudonyms: formats, links, round trips."""

import random
import re

import pyarrow.parquet as pq
import pytest

from kardex.llm import pii, queries

SF = "/root/testdata/sf0.001"
KEY = b"k" * 32
VALID = ["4111111111111111", "4111-1111-1111-1111", "378282246310005", "+1 (743) 555-3824", "+1 (017) 555-7713",
         "(212) 555-0199", "+44 20 7946 0958", "078-05-1120", "152.143.123.131", "GB82 WEST 1234 5698 7654 32",
         "2021-02-28", "28.02.2021", "02/28/2021", "28/02/2021", "und.34@mail7.example.com",
         "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"]
LEFT = ["4111111111111112", "1234567890123456", "000-12-3456", "256.1.1.1", "1.2.3", "2021-02-30", "31.04.2021",
        "GB82 WEST 1234 5698 7654 33", "no.mail@", "abc4111111111111111", "2021-02-28T", "", "12345"]


def shape(text):
    return re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", text)))


@pytest.mark.parametrize("value", VALID)
def test_replaced_in_format_and_reversed(value):
    replace, back = pii.replacer(KEY), pii.replacer(KEY, back=True)
    text = f"a: {value}, b\n{value}!!"
    new, n = replace(text)
    assert n == 2 and value not in new
    one, two = re.fullmatch(r"a: (.*), b\n(.*)!!", new).groups()
    assert one == two and back(new) == (text, 2)
    if re.fullmatch(r"[0-9a-f]{40}|[0-9A-F]{40}", value) is None and "." not in value[3:7]:
        assert shape(one) == shape(value)
    assert pii.replacer(b"o" * 32)(text)[0] != new
    plain = re.sub(r"\D", "", one)
    if value.startswith(("4", "37")):
        assert pii.luhn_digit(plain[:-1]) == plain[-1]
    if value.startswith("GB"):
        assert pii.iban_rest(one.replace(" ", "")) == 1


@pytest.mark.parametrize("value", LEFT)
def test_invalid_values_stay(value):
    text = f"a: {value} b"
    assert pii.replacer(KEY)(text) == (text, 0)


@pytest.mark.parametrize("before,value,after", [
    ("", "4111 1111 1111 1111", " 12/27"), ("", "4111111111111111", " 123"), ("order 12 ", "4111 1111 1111 1111", ""),
    ("1234 ", "4111 1111 1111 1111", " 5678"), ("2021-02-28 ", "4111 1111 1111 1111", ""),
    ("+44 20 7946 0958 ", "4111 1111 1111 1111", ""), ("3782 822463 10005 ", "4111-1111-1111-1111", " 77"),
    ("", "BE68 5390 0754 7034", " EUR 50"), ("", "ES91 2100 0418 4502 0005 1332", " BIC"),
    ("", "AT61 1904 3002 3457 3201", " 500"), ("IBAN ", "GB82 WEST 1234 5698 7654 32", " GBP 12"),
    ("", "+44 20 7946 0958", " 123456"), ("", "+1 (743) 555-3824", " 22"), ("order 12 ", "+1 743 555 3824", " 2027")])
def test_values_beside_numbers_and_words(before, value, after):
    kept = re.fullmatch(r"(?:order 12 |1234 |IBAN )?", before) is not None
    for i in range(30):
        key = bytes([i]) * 32
        text = f"a {before}{value}{after}, b"
        new, n = pii.replacer(key)(text)
        assert n == (1 if kept else 2) and len(new) == len(text) and value not in new and new.endswith(f"{after}, b")
        assert not kept or new.startswith(f"a {before}")
        assert pii.replacer(key, back=True)(new) == (text, n)
        alone = new[2 + len(before):len(new) - len(after) - 3]
        assert pii.replacer(key, back=True)(alone) == (value, 1) or before.startswith("1234") or after == " 123"


@pytest.mark.parametrize("value", [
    "+33 6 12 34 56 78", "+33 1 42 68 53 00", "06 12 34 56 78", "06.12.34.56.78", "01-42-68-53-00", "0612345678", "+33612345678",
    "+33 (0)6 12 34 56 78", "+34 612 34 56 78", "612 34 56 78", "+49 30 1234567", "030 1234567", "0171/1234567", "(030) 1234567",
    "020 7946 0958", "+44 (0)20 7946 0958"])
def test_phones_of_the_four_languages(value):
    for i in range(20):
        key = bytes([i]) * 32
        for text in (f"Tel. {value}.", f"({value}) et", f"{value}\n12 rue", f"a {value}, 4111 1111 1111 1111"):
            new, n = pii.replacer(key)(text)
            assert value not in new and shape(new) == shape(text), new
            assert pii.replacer(key, back=True)(new) == (text, n)


def test_one_number_in_national_and_international_form():
    replace = pii.replacer(KEY)
    a, b, c = (re.sub(r"\D", "", replace(x)[0]) for x in ("06 12 34 56 78", "+33 6 12 34 56 78", "0612345678"))
    assert a == c and a[1:] == b[2:]


@pytest.mark.parametrize("text", ["10 06 12 34 56 78 90", "01 02 03", "612 34 56", "0123", "2021 0301 11", "05 1234", "1/2/1990"])
def test_rows_of_numbers_are_no_phones(text):
    assert pii.replacer(KEY)(text) == (text, 0)


def planted(draw):
    """A value of a kind, made without the finder's patterns."""
    digits = lambda n: "".join(draw.choices("0123456789", k=n))
    kind = draw.randrange(7)
    if kind == 0:
        body = "4" + digits(14)
        card = body + pii.luhn_digit(body)
        return draw.choice([card, " ".join(card[i:i + 4] for i in range(0, 16, 4)), "-".join(card[i:i + 4] for i in range(0, 16, 4))])
    if kind == 1:
        pairs = ["0" + draw.choice("1234567")] + [digits(2) for _ in range(4)]
        return draw.choice([" ", ".", "-"]).join(pairs)
    if kind == 2:
        return f"+33 {draw.choice('1234567')} " + " ".join(digits(2) for _ in range(4))
    if kind == 3:
        return f"({draw.randrange(200, 990)}) {draw.randrange(200, 990)}-{digits(4)}"
    if kind == 4:
        return f"{draw.randrange(1950, 2030)}-{draw.randrange(1, 13):02d}-{draw.randrange(1, 29):02d}"
    if kind == 5:
        return ".".join(str(draw.randrange(256)) for _ in range(4))
    return f"{draw.choice(['anna', 'j.doe', 'x_9'])}{draw.randrange(100)}@mail.example.org"


def test_every_planted_value_is_found():
    draw, words = random.Random(11), "the le der von el cat ist et, chat. maison (note) 12 and 2023 in x-ray".split()
    for _ in range(300):
        values = [planted(draw) for _ in range(draw.randrange(1, 6))]
        text = "; ".join(" ".join(draw.choices(words, k=6)) + " : " + v for v in values)
        new, n = pii.replacer(KEY)(text)
        assert n == len(values), (n, values, text)
        assert not any(v in new for v in values) and pii.replacer(KEY, back=True)(new) == (text, n)


def test_numbers_in_a_row_are_reversed():
    draw = random.Random(5)
    for i in range(200):
        cards = [(b := "4" + "".join(draw.choices("0123456789", k=14))) + pii.luhn_digit(b) for _ in range(3)]
        cards = [re.sub(r"(....)(?=.)", r"\1 ", c) if draw.random() < 0.7 else c for c in cards]
        text = " ".join(x for c in cards for x in (str(draw.randrange(10 ** draw.randrange(1, 8))), c))
        new, n = pii.replacer(KEY)(text)
        assert n >= 3 and not any(c in new for c in cards) and pii.replacer(KEY, back=True)(new) == (text, n)
    table = " ".join(str(draw.randrange(10 ** draw.randrange(1, 9))) for _ in range(3000))
    new, n = pii.replacer(KEY)(table)
    assert n and pii.replacer(KEY, back=True)(new) == (table, n)


def test_equal_values_stay_linked_across_formats():
    replace = pii.replacer(KEY)
    a, b = replace("2021-02-28")[0], replace("on 02/28/2021.")[0]
    assert a[5:7] + "/" + a[8:] + "/" + a[:4] in b
    card = replace("4111 1111 1111 1111")[0]
    assert card.replace(" ", "") == replace("4111111111111111")[0]


def test_feistel_is_a_permutation():
    for size in (1, 2, 10, 97, 1000):
        net = pii.Feistel(KEY, "t", size)
        image = [net.apply(x) for x in range(size)]
        assert sorted(image) == list(range(size)) and [net.apply(y, back=True) for y in image] == list(range(size))


def test_query_round_trip(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    new = queries.op3_pii(spark, SF)
    rows = {r.doc_id: r for r in new.collect()}
    assert rows.keys() == docs.keys() and any(r.n_values for r in rows.values())
    mails = re.compile(r"[a-z.0-9]+@mail\d+\.example\.com")
    for k, r in rows.items():
        assert (r.text == docs[k]) == (r.n_values == 0)
        assert not set(mails.findall(docs[k])) & set(mails.findall(r.text))
    old = pii.pseudonymise(new, queries.PII_KEY, back=True)
    assert {r.doc_id: r.text for r in old.collect()} == docs


def test_awkward_rows(spark):
    rows = [(1, None, 5), (2, "", None), (2, "", None), (None, "x " * 500_000 + "4111111111111111", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_values long").withColumnRenamed("n_values", "N_Values")
    got = pii.pseudonymise(df, "k").collect()
    assert sorted((r.doc_id or 0, r.n_values) for r in got) == [(0, 1), (1, 0), (2, 0), (2, 0)]
    assert [r.text for r in got if r.doc_id == 1] == [None]
    assert pii.pseudonymise(df.limit(0), "k", count_col=None).columns == ["doc_id", "text", "N_Values"]
