import pytest
from conftest import as_dicts, by
from pyspark.sql import functions as F

from tradeloom.functions.text import postal_class
from tradeloom.plans.text_jobs import accepted_names, homepage_audit, phone_standardize, product_name_gate, rejected_names


def test_homepage_audit(frame):
    pages = [None, "http://a.b/c?d=1", "http://a.b/(c)", "http://café.b", "a~b", "plain a-b_c:@#%&+=/ .", "tab\there"]
    suppliers = frame("supplier_id int, company_name string, homepage string", *[(i, "s", page) for i, page in enumerate(pages)])
    assert set(by(homepage_audit(suppliers), "supplier_id")) == {1, 2, 3, 4}


PHONES = {
    "0123456789": ("(012) 345-6789", "(012) 345-6789"),
    "99-0123456789": ("(012) 345-6789", "(012) 345-6789"),
    "12-34 56": ("(123) 4 5-6000", "(123) 456-0000"),
    "": ("(000) 000-0000", "(000) 000-0000"),
    "abc": ("(bc0) 000-0000", "(000) 000-0000"),
}


def test_phones(frame):
    customers = frame("customer_id int, company_name string, phone string", (99, "none", None), *[
        (i, "c", phone) for i, phone in enumerate(PHONES)
    ])
    literal = by(phone_standardize(customers), "original_phone")
    corrected = by(phone_standardize(customers, corrected=True), "original_phone")
    assert {phone: (literal[phone]["formatted_phone"], corrected[phone]["formatted_phone"]) for phone in PHONES} == PHONES
    assert None not in literal
    assert len(as_dicts(phone_standardize(customers, limit=2))) == 2


@pytest.mark.parametrize(
    ("code", "expected"),
    [
        (None, "Unknown"), ("", "Unknown"), ("   ", "Unknown"), ("\t", "International"), ("12345", "Local"),
        ("12345-6789", "Local"), (" 123 45 ", "Local"), ("12345\n", "Local"), ("123-456", "National"),
        ("A1A 1A1", "International"), ("k1a0b1", "International"), ("SW1A 1AA", "International"), ("123456", "International"),
    ],
)
def test_postal_class(frame, code, expected):
    row = frame("code string", (code,)).select(postal_class(F.col("code")).alias("c")).first()
    assert row["c"] == expected


def test_product_names(frame):
    names = {
        1: (None, "NULL"), 2: ("  Abcd  ", "at least 5"), 3: ("lower case", "uppercase"), 4: ("1st choice", "uppercase"),
        5: ("Éclair au chocolat", "uppercase"), 6: (" Café Premium", None), 7: ("   Organic Tea   ", None),
    }
    products = frame("product_id int, product_name string", *[(key, name) for key, (name, _) in names.items()])
    rejected = by(rejected_names(products), "product_id")
    assert set(rejected) == {1, 2, 3, 4, 5}
    for key, row in rejected.items():
        assert names[key][1] in row["reason"]
        assert row["product_name"] == names[key][0]
    accepted = {key: row["product_name"] for key, row in by(accepted_names(products), "product_id").items()}
    assert accepted == {6: "Café Premium", 7: "Organic Tea"}
    gate = by(product_name_gate(products), "product_id")
    assert len(gate) == 7
    assert gate[7]["product_name"] == "Organic Tea"
