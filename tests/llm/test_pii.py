import random
import re

from rivalry.llm import pii
from tests.llm.conftest import ODD

MENTIONS = {
    "email": ["ann.lee7@mail.example.com", "ANN.LEE7@MAIL.EXAMPLE.COM"],
    "phone": ["+1 (678) 555-5272", "+1-678-555-5272"],
    "card": ["4111 1111 1111 1111", "4111111111111111"],
    "ip": ["58.40.156.104"],
    "secret": ["5aad00685accefdd91653537b82ad0dab34e35e3"],
    "iban": ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"],
    "ssn": ["123-45-6789"],
    "name": ["Mrs. Anna Lee", "Ms Anna Lee"],
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10


def replaced(documents, texts, key="k"):
    rows = pii.replace(documents(list(enumerate(texts))), key).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_kinds_keep_their_form(documents):
    flat = [m for found in MENTIONS.values() for m in found]
    out = replaced(documents, [f"see {m}!! and" for m in flat])
    new = dict(zip(flat, (t.removeprefix("see ").removesuffix("!! and") for t in out), strict=True))
    form = lambda x: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", x)))
    for kind, found in MENTIONS.items():
        for m in found:
            assert new[m] != m
            if kind in ("phone", "card", "ssn"):
                assert form(new[m]) == form(m)
            # one entity, one surrogate, each in its own format
            plain = lambda x: re.sub(r"[^a-z0-9]", "", x.lower())
            if kind != "name":
                assert plain(new[m]) == plain(new[found[0]])
    a, b = new["Mrs. Anna Lee"], new["Ms Anna Lee"]
    assert a.removeprefix("Mrs. ") == b.removeprefix("Ms ")
    assert a.split()[1] in pii.GIVEN["f", "latin"].split()
    assert luhn(new["4111111111111111"]) == 0 and new["ANN.LEE7@MAIL.EXAMPLE.COM"].isupper()
    assert all(0 < int(x) < 255 for x in new["58.40.156.104"].split("."))


def test_script_and_gender(documents):
    out = replaced(documents, ["г-н Иван Петров", "Herr Jörg Klein", "Dr. ANNA LEE"])
    assert re.fullmatch(r"г-н [А-Я][а-я]+ [А-Я][а-я]+", out[0])
    assert out[0].split()[1] in pii.GIVEN["m", "cyrillic"].split()
    assert out[1].split()[1] in pii.GIVEN["m", "latin"].split()
    assert out[2].isupper() is False and out[2][4:].isupper()


def test_other_text_stays(documents):
    texts = [
        "Apache License, Version 2.0.",
        "1.2.3.4.5 and 999.1.1.1 and 12-34 and 2024-01-02",
        "a@b and @name and user@host",
        "deadbeef 123456789012 Mr and Mrs",
        "x" * 200_000,
    ]
    assert replaced(documents, texts) == texts


def test_collisions_try_again(spark):
    # many values of a small form are real, so first attempts fail
    rows = [("ssn", f"{k:02d}") for k in range(40)]
    got = pii.assign(spark.createDataFrame(rows, "kind string, canonical string"), "k").collect()
    made = [r.surrogate for r in got]
    assert len(set(made)) == len(rows) and not set(made) & {c for _, c in rows}


def test_a_full_form_ends(documents, spark):
    """All phone numbers of five digits that begin with 1, and all numbers of a small form."""
    rows = [("phone", f"1{k:04d}") for k in range(10_000)] + [("ssn", str(k)) for k in range(10)]
    got = pii.assign(spark.createDataFrame(rows, "kind string, canonical string"), "k").collect()
    made = [(r.kind, r.surrogate) for r in got]
    assert len(got) == len(set(made)) == len(rows) and not set(made) & set(rows)


def test_coreference(documents):
    """Titles and bare family names tell one person; brute force over pairs of mentions."""
    out = replaced(
        documents,
        [
            "Dr Anna Lee met Ms Anna Lee. Ms Lee spoke, then Dr. Lee, then Mr Lee.",
            "Ms Lee alone; Mr Anna Lee Roe and Mr. Roe.",
            "Ms Eva Stone, Mr Otto Stone: Dr Stone, Ms Stone, Mr STONE",
            "Mr Kim Day and Ms Kim Day and Dr Kim Day",
        ],
    )
    a = re.fullmatch(r"Dr (\w+) (\w+) met Ms (\w+) (\w+)\. Ms (\w+) spoke, then Dr\. (\w+), then Mr (\w+)\.", out[0])
    assert a[1] == a[3] and a[2] == a[4] == a[5] == a[6] != a[7] and a[1] in pii.GIVEN["f", "latin"]
    b = re.fullmatch(r"Ms (\w+) alone; Mr (\w+) (\w+) (\w+) and Mr\. (\w+)\.", out[1])
    assert b[1] not in a.groups() and b[4] == b[5]
    c = re.fullmatch(r"Ms (\w+) (\w+), Mr (\w+) (\w+): Dr (\w+), Ms (\w+), Mr (\w+)", out[2])
    assert c[2] != c[4] and c[5] not in (c[2], c[4]) and c[6] == c[2] and c[7] == c[4].upper()
    d = re.fullmatch(r"Mr (\w+ \w+) and Ms (\w+ \w+) and Dr (\w+ \w+)", out[3])
    assert len({d[1], d[2], d[3]}) == 3


def test_check_digits_of_ibans(documents):
    valid = ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606"]
    for new in replaced(documents, valid):
        plain = new.replace(" ", "")
        digits = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        assert int(digits) % 97 == 1 and plain not in [v.replace(" ", "") for v in valid]


def test_entities_stay_apart(documents):
    """Brute force: two mentions get the same surrogate just if they are the same entity."""
    pick = random.Random(8)
    entities = []
    for _ in range(60):
        digits = "".join(pick.choices("0123456789", k=10))
        entities.append([f"+1 ({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"+1-{digits[:3]}-{digits[3:6]}-{digits[6:]}"])
        mail = "".join(pick.choices("ab", k=3)) + str(len(entities)) + "@x.org"
        entities.append([mail, mail.upper()])
    texts = [(k, m) for k, e in enumerate(entities) for m in e for _ in range(2)]
    out = replaced(documents, [m for _, m in texts])
    names = [re.sub(r"[^a-z0-9]", "", x.lower()) for x in out]
    by_entity = {k: {n for (j, _), n in zip(texts, names) if j == k} for k in range(len(entities))}
    assert all(len(x) == 1 for x in by_entity.values())
    assert len(set().union(*by_entity.values())) == len(entities)


def test_no_surrogate_is_a_real_name(spark):
    schema = "kind string, canonical string"
    rows = [("name", "f:anna lee"), ("name", "m:otto lang"), ("name", "x:kim roe")]
    first = {r.surrogate.lower() for r in pii.assign(spark.createDataFrame(rows, schema), "k").collect()}
    assert len(first) == 3
    rows += [("name", f"{g}:{name}") for name in first for g in "fx"]
    got = pii.assign(spark.createDataFrame(rows, schema), "k").collect()
    assert len(got) == len({r.surrogate for r in got}) == 9
    assert not {r.surrogate.lower() for r in got} & {c[2:] for _, c in rows}


def test_key_decides(documents):
    text = ["call +1 (678) 555-5272"]
    assert replaced(documents, text, "a") == replaced(documents, text, "a") != replaced(documents, text, "b")


def test_odd_rows(documents):
    rows = [*ODD, (7, "x@y.org"), (7, "x@y.org"), (None, "x@y.org x@y.org")]
    docs = documents(rows)
    got = pii.replace(docs, "k")
    assert got.columns == [*docs.columns, "n_entities"]
    found = got.collect()
    assert len(found) == len(rows)
    assert sorted(r.n_entities for r in found)[-3:] == [1, 1, 2]
    assert len({r.text for r in found if r.doc_id == 7}) == 1 and {r._id for r in found} == {"mine"}
    assert pii.replace(documents([]), "k").count() == 0
