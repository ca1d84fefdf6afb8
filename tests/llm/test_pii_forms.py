"""Personal data in digits of any script, and forms with few surrogates."""

import unicodedata

from pressmill.llm import pii


def full_width(text):
    return "".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in text)


def arabic(text):
    return "".join(chr(0x660 + int(c)) if c.isdigit() else c for c in text)


def test_digits_of_every_script(spark):
    plain = ["123-45-6789", "+1 (017) 555-7713", "4111 1111 1111 1111", "97.51.17.173", "DE44 5001 0517 5407 3249 31"]
    rows = [(i, "it is " + write(t)) for i, (t, write) in enumerate((t, w) for w in (str, full_width, arabic) for t in plain if w is str or t[0] != "D")]
    rows.append((99, "in 2024 " + arabic("123-45-6789") + " and " + full_width("4111 1111 1111 1111")))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(docs, b"key").collect()}
    for i, text in rows:
        new = got[i]["text"]
        assert got[i]["n_entities"] == (2 if i == 99 else 1)
        for a, b, *_ in pii.find(text):
            assert text[a:b] not in new
        assert [unicodedata.name(c)[:6] for c in text if c.isdecimal()][:3] == [unicodedata.name(c)[:6] for c in new if c.isdecimal()][:3]
    assert pii._plain(got[5]["text"]) == got[0]["text"]  # one entity in either script


def test_forms_without_room_end(spark):
    octets = "12345"
    full = [f"{a}.{b}.{c}.{d}" for a in "123456789" for b in "123456789" for c in "123456789" for d in "123456789"]
    tails = [("email", "_@-." + c) for c in octets] + [("family", "\U00016fe4")]
    found = spark.createDataFrame([(1, "ip", x) for x in full] + [(1, *t) for t in tails], "text_hash long, kind string, entity string")
    odd = {(r["kind"], r["entity"]): r["attempt"] for r in pii.collisions(found, b"key").collect()}
    new = [pii.surrogate(b"key", "ip", x, odd.get(("ip", x), 0)) for x in full]
    assert len(set(new)) == len(full) and not set(new) & set(full)
    assert all(pii.surrogate(b"key", k, e, odd.get((k, e), 0)) != e for k, e in tails)


def test_late_attempts_have_more_room():
    for kind, entity in (("ssn", "123456789"), ("card", "4111111111111111"), ("phone", "+10175557713"), ("ip", "1.2.3.4"), ("secret", "a1" * 16),
                         ("email", "_@-.com"), ("family", "漢"), ("name_f", "Ada"), ("iban", "DE44500105175407324931")):
        assert len(pii.surrogate(b"key", kind, entity, 640)) > len(entity)
        assert len({pii.surrogate(b"key", kind, entity, a) for a in range(320, 400)}) == 80
    assert pii.write("123-45-6789", "ssn", "9876543210") == "987-65-43210"
