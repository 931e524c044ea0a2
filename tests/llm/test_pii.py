import random
import re

import pytest
from helpers import with_clashes

from skyloom.llm import pii


#: As if learned from a corpus.
KNOWN = pii.Words(pii.bitmap(map(pii.code, "Beatrice Hugh Nora Arthur Karl Mary Mei Hans Anna Pierre Jeanne Hélène Margaret Rose Agnes".split())))


def items(text):
    return [(k, text[a:b]) for k, a, b in pii.find(text, KNOWN)]


CASES = [
    ("Write to ann.lee_07@harbour.example.com, or call.", [("email", "ann.lee_07@harbour.example.com")]),
    ("Mail: ann-lee (at) post.example today", [("email", "ann-lee (at) post.example")]),
    ("Mail ann.lee at post dot example dot org and wait", [("email", "ann.lee at post dot example dot org")]),
    ("Mail ann.lee @ post.example.\nEggs @ 15c a dozen", [("email", "ann.lee @ post.example")]),
    ("Mail ann©post,example", [("email", "ann©post,example")]),
    ("Phone +44 1632 960409 now", [("phone", "+44 1632 960409")]),
    ("Phone (01632) 960 418.", [("phone", "(01632) 960 418")]),
    ("ring 020\n7946 0045. In 1990", [("phone", "020\n7946 0045")]),
    ("ring ((919) 555-0164) or", [("phone", "(919) 555-0164")]),
    ("ring 919.555.0164, or +1 805 555 0136. The", [("phone", "919.555.0164"), ("phone", "+1 805 555 0136")]),
    ("No agents. 555-0157.", [("phone", "555-0157")]),
    ("Tél. 01.99.00.28.13 ou +33 1 99 00 67 19.", [("phone", "01.99.00.28.13"), ("phone", "+33 1 99 00 67 19")]),
    ("Telefon (030) 23125 526 oder 030/23125-031", [("phone", "(030) 23125 526"), ("phone", "030/23125-031")]),
    ("teléfono 91 000 0908 o +34 910 O00 315. El", [("phone", "91 000 0908"), ("phone", "+34 910 O00 315")]),
    ("ISSN 0317-4441, patent 4,402,737, Lot 64-207, Ref. B-451, Minute 14-7, 42 000 pesetas", []),
    ("His papers gave the number 918 77 8621, which", [("id_number", "918 77 8621")]),
    ("a card numbered QQ234678C was; number 935393073 and", [("id_number", "QQ234678C"), ("id_number", "935393073")]),
    ("mit Ausweis Nr.\nT 22 000\n315; abzugeben", [("id_number", "T 22 000\n315")]),
    ("avec carte n° 2 56 13 99 644 852 34; le", [("id_number", "2 56 13 99 644 852 34")]),
    ("con documento 00087863-W; avisar", [("id_number", "00087863-W")]),
    ("Apply Apt. 4B, 3930A Coldwell Road. The corner of Heron Lane is closed", [("address", "Apt. 4B, 3930A Coldwell Road")]),
    ("at 6 St. Osric Lane, or 145 Heron\nRd.\nA FAIR", [("address", "6 St. Osric Lane"), ("address", "145 Heron\nRd.")]),
    ("wohnhaft Linclenweg 11, dann Waldstr. 112b, Telefon", [("address", "Linclenweg 11"), ("address", "Waldstr. 112b")]),
    ("à le 126 bis, rue du Vieux Puits, et 44 avenue de la Forge.", [("address", "126 bis, rue du Vieux Puits"), ("address", "44 avenue de la Forge")]),
    ("vecino de C/ de la Fragua n.º 4, y Calle Las Parras, 58.", [("address", "C/ de la Fragua n.º 4"), ("address", "Calle Las Parras, 58")]),
    ("Signed, Agnes R. Selkovick, of", [("person_name", "Agnes R. Selkovick")]),
    ("from Bea-\ntriee Lambensworth (", [("person_name", "Bea-\ntriee Lambensworth")]),
    ("Winners: Varlandry, Hugh B.; LAM-\nBIDDOW, Nora; and Arthur Selkovick.", [("person_name", "Varlandry, Hugh B."), ("person_name", "LAM-\nBIDDOW, Nora"), ("person_name", "Arthur Selkovick")]),
    ("call on Rev. P. Selkiddow. Mr. and Mrs. Holm of", [("person_name", "P. Selkiddow"), ("person_name", "Holm")]),
    ("Frau Calding aus Ort; Karl Holvenbruck-Fennenbruck begrüßte", [("person_name", "Calding"), ("person_name", "Karl Holvenbruck-Fennenbruck")]),
    ("le M. Dunneval, de la ville, et le M. W. Lambagnol, de Port, et la", [("person_name", "Dunneval"), ("person_name", "W. Lambagnol")]),
    ("he saw Mr Young and Mary Cook, then J. Page and Mrs. A. Best at noon", [("person_name", "Young"), ("person_name", "Mary Cook"), ("person_name", "J. Page"), ("person_name", "A. Best")]),
    ("the late Mei Li and Hans von Berg met Anna van der Velde, Pierre de la Tour and Jeanne d'Arlon", [("person_name", x) for x in ("Mei Li", "Hans von Berg", "Anna van der Velde", "Pierre de la Tour", "Jeanne d'Arlon")]),
    ("or call on Mr.\nFREE delivery. The corner of Rose Lane. Mrs. The water; Mary In", []),
    ("Messrs. Tarniddow and Quillamere & Sons; Casa Kestuelles; Hijos de Marlirazo; Gebr. Selkhauser", []),
    ("The steamer Lady Margaret left Lowen Quay", []),
]


@pytest.mark.parametrize("text, want", CASES)
def test_items(text, want):
    assert items(text) == want


@pytest.mark.parametrize("number", ["QQl87780C", "QQO34235C", "QQS38929C", "QQB54292A", "QQB38003C", "QQO19192C", "ACl2834SC"])
def test_identity_numbers_whose_first_digits_are_misread(number):
    assert items(f"A wallet with a card numbered {number} was handed in") == [("id_number", number)]


def test_areas_lose_no_number(monkeypatch):
    rnd = random.Random(7)
    heads = ["number ", "card QQ", "Nr. T ", "n° ", "ring ", "(", "+", "X-", "AB "]
    texts = [rnd.choice(heads) + "".join(rnd.choice("0123456789012345678901234567890OolISBb    ..--/()+ACZ,") for _ in range(rnd.randrange(6, 22))) + rnd.choice(["", " ", "C was", "-W; ", " A, "]) for _ in range(20_000)]
    texts += [rnd.choice(heads) + re.sub("9", lambda _: rnd.choice("0123456789OlSB"), x) + rnd.choice([".", " was", ""]) for x in ["999 99 9999", "QQ999999C", "QQ 99 99 99 A", "T 99 999 999", "2 99 99 99 999 999 99", "99999999-W", "X-9999999-L", "+44 9999 999999", "(099) 999 9999", "999-9999", "09 99 99 99 99"] for _ in range(500)]
    got = [list(pii.find_numbers(t)) for t in texts]
    assert sum(map(len, got)) > 2_000
    monkeypatch.setattr(pii, "_areas", lambda s: [(0, len(s))])
    assert got == [list(pii.find_numbers(t)) for t in texts]


def test_positions_count_code_points_of_the_text_itself():
    for text, want in CASES:
        for lead in ("", "é́🙂 x-\r\n", "Hélène x\r\n", "ô\n\n"):
            full = lead + text.replace("\n", "\r\n")
            got = [(k, full[a:b].replace("\r\n", "\n")) for k, a, b in pii.find(full, KNOWN)]
            assert [g for g in got if g in want] == want
    t = "chez Hélène Brandlanchet, 11 rue des Lilas"
    assert items(t) == [("person_name", "Hélène Brandlanchet"), ("address", "11 rue des Lilas")]


def test_redaction_changes_nothing_else():
    t = "Signed, Agnes R. Selkovick, 145 Heron\r\nRd., ann@post.example.\n"
    assert pii.redact(t) == "Signed, [PERSON_NAME], [ADDRESS], [EMAIL].\n"
    assert pii.redact("nothing here") == "nothing here" and pii.redact("") == ""


def test_check_digits_decide(monkeypatch):
    """A number without a word that speaks for it counts if its check digit holds and is rejected if it does not."""
    good = ["946454287", "2 55 08 14 168 025 38", "12345678Z", "X1234567L", "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"]
    bad = ["946454288", "2 55 08 14 168 025 39", "12345678A", "X1234567A", "4111 1111 1111 1112", "DE88 3704 0044 0532 0130 00"]
    for x, y in zip(good, bad):
        assert items(f"They wrote {x} on it.") == [("id_number", x)], x
        assert "id_number" not in dict(items(f"They wrote {y} on it.")), y
    for y in bad[:4]:
        assert items(f"A card numbered {y} was seen.") == [("id_number", y)]
    assert items("Registered 946454287 in May.") == []
    for name in ("luhn", "mod97", "dni", "iban"):
        monkeypatch.setattr(pii, name, lambda *a: False)
    assert not any("id_number" in dict(items(f"They wrote {x} on it.")) for x in good)
    for name in ("luhn", "mod97", "dni", "iban"):
        monkeypatch.setattr(pii, name, lambda *a: True)
    assert all(items(f"They wrote {x} on it.") == [("id_number", x)] for x in bad)


def test_given_names_are_learned_from_the_corpus(spark):
    """Names of many countries, in no list: most stand bare in running text, where only what was learned elsewhere shows them."""
    rnd = random.Random(3)
    given = "Giuseppe Hiroshi Olga Lars Kwame Ingeborg Rajesh Fatima Nikolai Aoife Bjarne Chidi Danuta Emre Farid Goran Haruki Ioana Jaroslav Katarzyna Leila Mateusz Nkechi Oksana Paolo Quang Rosalba Sanjay Tuulikki Umberto".split()
    family = "Rossi Tanaka Petrova Johansson Nkrumah Haugen Sharma Haddad Volkov Byrne Madsen Okafor Kowalska Yilmaz Nazari Horvat Sato Popescu Novak Wrona Karimi Zielinski Eze Shevchenko Greco Tran Bianchi Patel Virtanen Conti".split()
    places = ["Upper Dray", "Marsh Eaton", "Ellerby Cross"]
    texts, true = [], 0
    for i in range(900):
        g, f, p = rnd.choice(given), rnd.choice(family), rnd.choice(places)
        if i % 5 == 0:
            texts.append((i, f"The meeting heard Mr {g} {f} speak on the drains of {p}.", None))
        elif i % 5 == 1:
            texts.append((i, f"It is known that {p} won, and Marsh Eaton drew.", None))
        else:
            texts.append((i, rnd.choice([f"It was thought that {g} {f} had gone to {p}.", f"The letter which {g} {f} sent from {p} came late."]), f"{g} {f}"))
            true += 1
    d = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    found = {(r["doc_id"], texts[r["doc_id"]][1][r["start_pos"] : r["end_pos"]]) for r in pii.found(d).collect()}
    hits = sum((i, n) in found for i, _, n in texts if n)
    assert hits >= 0.9 * true
    assert not [x for x in found if x[1] in places]
    bare = {(r["doc_id"]) for r in pii.found(d.where("doc_id % 5 > 1")).collect()}
    assert not bare  # nothing to learn from


def test_validators():
    assert pii.iban("GB82 WEST 1234 5698 7654 32") and not pii.iban("GB82 WEST 1234 5698 7654 33") and not pii.iban("GB82")
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487") and not pii.luhn("")
    assert pii.mod97("255081416802538") and not pii.mod97("255081416802539") and not pii.mod97("1")
    assert pii.dni("12345678", "Z") and not pii.dni("12345678", "A")


def test_shapes_meet_misread_words():
    for a, b in (("Beatrice", "Beatriee"), ("Karl", "Knrl"), ("Julián", "Jnlián"), ("Linden", "Linclen"), ("Osric", "Oſric"), ("Sra", "Srn")):
        assert pii.shape(a) == pii.shape(b)


@pytest.mark.parametrize("text", ["+1" + "2" * 3000 + "a", "A. " * 20_000, "He\u0301le\u0300ne\n" * 20_000, "x@" + "a" * 50_000, "9" * 50_000, "1 " * 50_000, "Agnes " * 20_000, "(" * 30_000, "a-\n" * 30_000, "@ " * 30_000])
def test_long_and_odd_texts_take_linear_time(text):
    import time

    t = time.process_time()
    pii.find(text, KNOWN)
    assert time.process_time() - t < 5


def test_rows(spark):
    long = "Words of a very long page. " * 40_000 + "Signed, Agnes R. Selkovick."
    d = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t"), (4, "ring 555-0157."), (4, "ring 555-0157."), (5, long), (None, "x")], "doc_id bigint, text string")
    got = sorted(map(tuple, pii.found(with_clashes(d)).collect()))
    a = long.index("Agnes")
    assert got == [(4, "phone", 5, 13), (4, "phone", 5, 13), (5, "person_name", a, a + 18)]
    r = {x["doc_id"]: x["text"] for x in pii.redacted(d).collect()}
    assert r[1] is None and r[2] == "" and r[4] == "ring [PHONE]." and r[5].endswith("[PERSON_NAME].")
    assert pii.found(d.limit(0)).count() == 0
