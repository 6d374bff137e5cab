"""op6 on planted entities: every mention goes, others stay, and who was one stays one."""

import random
import re

import pytest

from presslens.llm import pii, queries
from tests.conftest import SF

KEY = "key of the tests"


@pytest.mark.parametrize(
    ("text", "shape", "kept"),
    [
        ("+33 1 23 45 67 89", r"\+33 \d \d\d \d\d \d\d \d\d", "33"),
        ("+49 (0)30 123456", r"\+49 \(0\)\d\d \d{6}", "49"),
        ("+996 555 123 456", r"\+996 \d{3} \d{3} \d{3}", "996"),
        ("+1 (212) 555-0123", r"\+1 \(\d{3}\) \d{3}-\d{4}", "1"),
        ("+1 (017) 555-7713", r"\+1 \(\d{3}\) \d{3}-\d{4}", "1"),
        ("+7 912 345 67 89", r"\+7 \d{3} \d{3} \d\d \d\d", "7"),
        ("0171 2345 678", r"0[1-9]\d\d \d{4} \d{3}", "0"),
    ],
)
def test_phones_keep_country_and_form(text, shape, kept):
    new, found = pii.anonymise(text, KEY)
    assert [e["kind"] for e in found] == ["phone"]
    assert re.fullmatch(shape, new) and new != text
    assert pii.phone_parts(new)[0 if text.startswith("+") else 1] == kept


@pytest.mark.parametrize("text", ["2024-01-15 10:30", "on 2024-01-15 10 30 00", "15.01.2024 10.30", "order 1234567890123", "version 2024.01.15.1", "15 01 2024 1030"])
def test_dates_and_order_numbers_stay(text):
    assert pii.anonymise(text, KEY) == (text, [])


def test_numbers_of_different_countries_are_different_entities():
    texts = ["+33 1 23 45 67 89", "+43 1 23 45 67 89", "+1 212 555 0123", "+44 212 555 0123"]
    found = [pii.anonymise(t, KEY)[1][0] for t in texts]
    assert len({e["entity"] for e in found}) == len({e["surrogate"] for e in found}) == 4
    assert pii.anonymise("+1 (212) 555-0123", KEY)[1][0]["entity"] == found[2]["entity"]


def test_cards_of_sixteen_digits_or_with_a_right_check_digit():
    assert [e["kind"] for e in pii.anonymise("9807 9157 6280 4490", KEY)[1]] == ["card"]
    assert [e["kind"] for e in pii.anonymise("4222222222222", KEY)[1]] == ["card"]
    new = pii.anonymise("4845168114407329", KEY)[0]
    assert new != "4845168114407329" and pii.luhn(new[:-1]) == int(new[-1])


def planted(draw):
    """One entity of each kind as the documents write them."""
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    return [f"user.{digits(3)}@mail{digits(1)}.example.com", f"+1 ({digits(3)}) 555-{digits(4)}", digits(16), ".".join(str(draw.randrange(1, 255)) for _ in range(4)), f"{digits(3)}-{digits(2)}-{digits(4)}", f"+{draw.choice(['33', '49', '996'])} {digits(3)} {digits(3)} {digits(3)}"]


def test_every_planted_entity_goes_and_coreference_stays(spark):
    draw = random.Random(9)
    people = [planted(draw) for _ in range(60)]
    rows = [(i, f"Write to {p[0]} or call {p[1]}, {p[5]}. Card {p[2]}, host {p[3]}, number {p[4]}. Again: {p[0]}; plain words {i} stay.") for i, p in enumerate(people)] * 2 + [(None, people[0][0]), (900, None), (901, ""), (902, "nothing here")]
    out = pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()
    assert len(out) == len(rows)
    names = {}
    for r in out:
        if r["doc_id"] is None or r["doc_id"] >= 900:
            continue
        assert not any(e in r["text"] for e in people[r["doc_id"]]) and f"plain words {r['doc_id']} stay." in r["text"]
        assert [e["kind"] for e in r["entities"]] == ["email", "phone", "phone", "card", "ip", "ssn", "email"]
        assert r["entities"][0]["entity"] == r["entities"][-1]["entity"]
        for e in r["entities"]:
            assert names.setdefault((e["kind"], e["surrogate"]), e["entity"]) == e["entity"]
            assert r["text"][e["start"] : e["end"]]
    assert len({e for (kind, _), e in names.items() if kind == "card"}) == len({p[2] for p in people})
    assert {r["doc_id"]: r["text"] for r in out if r["doc_id"] and r["doc_id"] >= 900} == {900: None, 901: "", 902: "nothing here"}


def test_query_equals_plain_replacement(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["text"], r["n_entities"], r["distinct_surrogates"]) for r in queries.op6_surrogates(spark, SF).collect()}
    key, seen, plain = queries.SAMPLE_KEY, {}, {}
    for i, text in docs.items():
        new, entities = pii.anonymise(text, key)
        plain[i] = (new, entities)
        for e in entities:
            seen.setdefault((e["kind"], e["surrogate"]), set()).add(e["entity"])
    assert got == {i: (new, len(es), all(len(seen[e["kind"], e["surrogate"]]) == 1 for e in es)) for i, (new, es) in plain.items()}
