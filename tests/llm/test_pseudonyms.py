"""Pseudonyms: formats, validity, links between documents, and the network itself."""

from __future__ import annotations

import datetime
import hashlib
import re

from rowcast.llm.pseudonyms import KINDS, pseudonymized


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def permuted(text, key, kind, letters=26):
    half = len(text) // 2
    a, b = text[:half], text[half:]
    for i in range(1, 9):
        noise = hashlib.sha256("|".join((key, kind, str(len(text)), str(i), b)).encode()).hexdigest()
        moved = ""
        for j, c in enumerate(a):
            by = int(noise[2 * j : 2 * j + 2], 16)
            if c.isdigit():
                c = chr((ord(c) - 48 + by) % 10 + 48)
            elif "a" <= c < chr(97 + letters):
                c = chr((ord(c) - 97 + by) % letters + 97)
            elif "A" <= c < chr(65 + letters):
                c = chr((ord(c) - 65 + by) % letters + 65)
            moved += c
        a, b = b, moved
    return a + b


def run(spark, texts, key="k"):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pseudonymized(frame, key).orderBy("doc_id").collect()]


def kinds(row):
    return {k: row[f"n_{k}"] for k in KINDS if row[f"n_{k}"]}


def test_every_kind_keeps_its_format(spark):
    texts = [
        "mail jo.Smith+x9@mail7.example.com.", "ip 97.51.17.173!", "card 4111111111111111", "card 4111 1111 1111 1111.",
        "iban DE89370400440532013000", "iban DE89 3704 0044 0532 0130 00", "ssn 123-45-6789", "on 2023-02-28", "on 31.12.1999.",
        "on 12/25/2020", "call +1 (017) 555-7713", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"###",
    ]
    for text, row in zip(texts, run(spark, texts)):
        shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", t)))
        assert row.text != text and sum(kinds(row).values()) == 1, row
        if "ip" not in kinds(row):
            assert shape(row.text) == shape(text)
    rows = run(spark, texts)
    assert luhn(re.sub("[^0-9]", "", rows[2].text)) and luhn(re.sub("[^0-9]", "", rows[3].text))
    assert re.sub("[^0-9]", "", rows[2].text) == re.sub("[^0-9]", "", rows[3].text)
    plain = rows[4].text.split()[1]
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert all(int(p) < 256 for p in rows[1].text[3:-1].split("."))
    datetime.date.fromisoformat(rows[7].text[3:])
    datetime.datetime.strptime(rows[8].text[3:-1], "%d.%m.%Y")
    datetime.datetime.strptime(rows[9].text[3:], "%m/%d/%Y")


def test_network_equals_a_plain_one(spark):
    rows = run(spark, ["x 4111111111111111", "aB3.c@b.org", "ab" * 20], key="other")
    body = permuted("411111111111111", "other", "card")
    assert rows[0].text[2:-1] == body
    assert rows[1].text == permuted("aB3.c", "other", "email") + "@b.org"
    assert rows[2].text == permuted("ab" * 20, "other", "secret", 6)


def test_invalid_values_and_plain_texts_stay(spark):
    texts = [
        "4111111111111112", "999.1.1.1", "2023-02-30", "666-12-1234", "DE88370400440532013000", "version 3.14 of 2020", None, "",
        "$12,345.67 at 10:30", "a" * 5000 + "@", "1" * 4000, "\n\n", "x@y",
    ]
    for text, row in zip(texts, run(spark, texts)):
        assert row.text == text and not kinds(row), row


def test_every_ordered_pair_of_kinds_side_by_side(spark):
    values = {
        "email": ["jo.Smith+x9@mail7.example.com", "12ab@b.org"],
        "secret": ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"],
        "iban": ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "AT61 1904 3002 3457 3201"],
        "ssn": ["123-45-6789"],
        "date": ["2020-01-02", "31.12.1999", "12/25/2020"],
        "ip": ["190.137.223.204", "10.1.22.7"],
        "phone": ["+1 (826) 555-4081", "+49 30 1234567", "+14155552671", "(212) 555-1234", "212-555-1234"],
        "card": ["4111111111111111", "4111 1111 1111 1111", "5500 0000 0000 0004", "3782 822463 10005"],
    }
    flat = [(kind, value) for kind, all_of in values.items() for value in all_of]
    alone = dict(zip((value for _, value in flat), (row.text for row in run(spark, [value for _, value in flat]))))
    assert all(value != fresh for value, fresh in alone.items())
    pairs = [(a, b, gap) for a in flat for b in flat for gap in (" ", ", ", "\n")]
    for (a, b, gap), row in zip(pairs, run(spark, [a[1] + gap + b[1] for a, b, gap in pairs])):
        assert row.text == alone[a[1]] + gap + alone[b[1]], (a, b, gap, row.text)
        assert kinds(row) == ({a[0]: 2} if a[0] == b[0] else {a[0]: 1, b[0]: 1})


def test_what_fails_hides_nothing(spark):
    texts = [
        "2021 4111 1111 1111 1111", "XX12 4111 1111 1111 1111", "+1 (826) 555-4081 12", "+49 30 1234567 190.137.223.204 2020-01-02",
        "AT61 1904 3002 3457 3201 IS MINE", "+123 1234567890123456 and 1.2.3.4", "+49 30 999-45-6789",
    ]
    card, phone, other, ip, day, iban, short = (
        r.text for r in run(spark, ["4111 1111 1111 1111", "+1 (826) 555-4081", "+49 30 1234567", "190.137.223.204", "2020-01-02",
                                    "AT61 1904 3002 3457 3201", "1.2.3.4"])
    )
    rows = [r.text for r in run(spark, texts)]
    assert rows[:6] == [
        "2021 " + card, "XX12 " + card, phone + " 12", f"{other} {ip} {day}", iban + " IS MINE", "+123 1234567890123456 and " + short,
    ]
    assert "999-45-6789" not in rows[6]
    # More candidates than are put in place at a time.
    many = run(spark, ["2021 4111 1111 1111 1111, " * 700])[0]
    assert many.text == f"2021 {card}, " * 700 and many.n_card == 700


def test_values_are_linked_and_never_meet(spark):
    numbers = [f"10.0.{i // 200}.{i % 200}" for i in range(400)]
    dates = [str(datetime.date(1999, 1, 1) + datetime.timedelta(days=i)) for i in range(400)]
    rows = run(spark, [" ".join(numbers), " ".join(dates), " and ".join(reversed(numbers)), "$".join(numbers[:3])])
    one, two = rows[0].text.split(), rows[2].text.split(" and ")
    assert one == two[::-1] and len(set(one)) == 400 and rows[0].n_ip == 400
    assert len(set(rows[1].text.split())) == 400
    assert rows[3].text.split("$") == one[:3]
    assert run(spark, [numbers[0]], key="k2")[0].text != one[0]


def test_tables(spark):
    frame = spark.createDataFrame([(None, "1.2.3.4", 9, "x"), (None, "1.2.3.4", 9, "x")], "doc_id long, text string, n_ip int, other string")
    out = pseudonymized(frame, "k")
    assert set(out.columns) == {"doc_id", "text", "other", *(f"n_{k}" for k in KINDS)}
    assert [r.n_ip for r in out.collect()] == [1, 1]
    assert pseudonymized(frame.limit(0), "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_the_key_is_not_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "write to someone@example.org or +1 (826) 555-4081")], "doc_id long, text string")
    out = pseudonymized(frame, "very-secret-key")
    assert "someone" not in out.collect()[0].text
    execution = out._jdf.queryExecution()
    for shown in (execution.toString(), execution.executedPlan().toString(), execution.logical().toString(), execution.optimizedPlan().toString()):
        assert "very-secret-key" not in shown
    assert not any(name in execution.executedPlan().toString() for name in ("Python", "Arrow", "NestedLoop"))


def test_one_phone_number_in_any_layout_is_one_pseudonym(spark):
    for number in (["+18265554081", "+1 826 555 4081", "+1 (826) 555-4081", "+1.826.555.4081"], ["+49301234567", "+49 30 1234567", "+49 (30) 1234 567"]):
        texts = [r.text for r in run(spark, [f"call {n} now" for n in number])]
        digits = ["".join(c for c in t if c.isdigit()) for t in texts]
        assert len(set(digits)) == 1 and digits[0] != "".join(c for c in number[0] if c.isdigit())
        assert [len(t) for t in texts] == [len(n) + 9 for n in number]
