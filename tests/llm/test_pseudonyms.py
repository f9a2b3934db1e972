import re

import pytest

from harvestframe.llm import pseudonyms as P


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutation(size):
    go, back = P.Permutation(b"k"), P.Permutation(b"k", False)
    image = [go(x, size, "t") for x in range(size)]
    assert sorted(image) == list(range(size)) and all(a != b for a, b in enumerate(image))
    assert [back(y, size, "t") for y in image] == list(range(size))
    if size > 10:
        assert image != [P.Permutation(b"other")(x, size, "t") for x in range(size)]


KEEP = ["v 4.0. 1.2.3", "4111111111111112", "999.1.1.1", "2024-02-30", "000-12-1234", "a@b", "1234567", "GB00WEST12345698765432", "05 June", "0000000000000000"]
GO = {"joe.smith+x@mail7.example.com": "email", "+1 (564) 555-4526": "phone", "564-555-4526": "phone", "108.51.216.133": "ip", "4111 1111 1111 1111": "card",
      "7536784127813050": "card", "378282246310005": "card", "GB82WEST12345698765432": "iban", "078-05-1120": "ssn", "2024-02-29": "date", "31.12.1999": "date", "12/31/1999": "date"}


def valid(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "card":
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    if kind == "iban":
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1
    return kind != "ip" or all(int(x) < 256 for x in text.split("."))


def test_formats_links_and_round_trip():
    go, back = P.Permutation(b"k"), P.Permutation(b"k", False)
    for text, kind in GO.items():
        line = f"see {text}, or {text}. {' '.join(KEEP)}"
        new, spans = P.replaced(line, go, {})
        own = text.partition("@")[0]
        assert [k for *_, k in spans] == [kind] * 2 and own not in new
        first = new[4:new.index(",")]
        assert new == f"see {first}, or {first}. {' '.join(KEEP)}" and valid(kind, first.partition("@")[0])
        if kind != "ip":
            assert [c.isdigit() for c in first] == [c.isdigit() for c in text]
        assert P.replaced(new, back, {})[0] == line
        assert [line[a:b] for a, b, _ in spans] == [own, own]


def test_written_forms_are_linked():
    go, back = P.Permutation(b"k"), P.Permutation(b"k", False)
    same = [("iban", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"), ("iban", "BE68539007547034", "BE68 5390 0754 7034"),
            ("card", "378282246310005", "3782 822463 10005", "3782-822463-10005"), ("phone", "(555) 123-4567", "5551234567", "+15551234567", "+1 555-123-4567"),
            ("phone", "+44 20 7946 0958", "+442079460958", "+44-20-7946-0958"), ("phone", "+33 1 23 45 67 89", "+33123456789"),
            ("date", "1/5/2024", "2024-05-01", "01.05.2024", "2024.5.1"), ("date", "31-12-2024", "2024.12.31", "12/31/2024", "31/12/2024")]
    for kind, *spellings in same:
        values = set()
        for text in spellings:
            line = f"see {text} AND 2023-07-09, or {text}."
            new, spans = P.replaced(line, go, {})
            assert [k for *_, k in spans] == [kind, "date", kind] and [line[a:b] for a, b, _ in spans][::2] == [text, text], (line, spans)
            first = new[4:new.index(" AND")]
            assert len(first) == len(text) and first != text and P.replaced(new, back, {})[0] == line
            assert [c.isalnum() for c in first] == [c.isalnum() for c in text]
            order = sorted(re.findall("[0-9]+", first), key=int) if kind == "date" else re.findall("[A-Z0-9]", first)
            values.add(tuple(str(int(x)) for x in order) if kind == "date" else "".join(order)[-10:])
        assert len(values) == 1, (spellings, values)
    for i in range(2000):
        line = f"{i % 28 + 1}/{i % 12 + 1}/{1900 + i % 200} 2{i:09d} +49 {30 + i} {1000 + i} {2000 + i}"
        assert P.replaced(P.replaced(line, go, {})[0], back, {})[0] == line
    card = P.replaced("AB12 4111 1111 1111 1111", go, {})
    assert [s[2] for s in card[1]] == ["card"]


def test_documents_round_trip(df, docs):
    new = P.pseudonymised(df, b"key")
    assert set(new.columns) == set(df.columns)
    rows = new.select("doc_id", "text", "pii").collect()
    back = P.pseudonymised(new, b"key", restore=True).select("doc_id", "text").collect()
    assert sorted(map(str, back)) == sorted(map(str, df.select("doc_id", "text").collect()))
    marked = next(r for r in rows if r.text and "AKIA" in r.text)
    assert [s.kind for s in marked.pii] == ["email", "card"] and "joe.smith" not in marked.text
    assert all(r.pii == [] for r in rows if r.text in (None, "", "one"))


def test_empty(nothing):
    assert P.pseudonymised(nothing).count() == 0
