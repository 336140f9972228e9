import datetime
import ipaddress
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import pii as I
from tests.llm.data import awkward, empty, frame, row

KEY = b"test"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    got = [I.feistel(i, size, b"k", "t") for i in range(size)]
    assert sorted(got) == list(range(size)) and [I.feistel(x, size, b"k", "t", back=True) for x in got] == list(range(size))


def card(body: str) -> str:
    return body + I.luhn_digit(body)


VALUES = {"email": ["jo.doe42", "A-b_c", "x"], "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"], "ip": ["1.2.3.4", "255.255.255.255", "0.0.0.0"],
          "date": ["2020-02-29", "29.02.2020", "03/04/2020", "25/12/1999", "12/25/1999", "1900-01-01"], "ssn": ["123-45-6789", "665-01-0001", "667-99-9999"],
          "card": [card("404189497460879"), "4041-8949-7460-8795", card("37828224631000")], "phone": ["+1 (988) 555-2485", "+44 20 7946 0958", "(212) 555-0100", "+49 0151 23456789"]}
VALUES["ipv6"] = ["2001:db8::1", "fe80::1ff:fe23:4567:890a", "2001:0db8:0000:0000:0000:ff00:0042:8329", "fe80::1", "2001:DB8:0:0:8:800:200C:417A"]
VALUES["date"] += ["5/3/2001", "12.5.2001", "2001-5-3", "7 May 2001", "May 12, 1987", "3 Jun 1999", "DEC 31, 1999", "01 august 2020"]
VALUES["phone"] += ["826-555-4081", "826.555.4081", "+1 826 155 4081", "+44 (0)20 7946 0958"]
VALUES["iban"] += ["GR16 0110 1250 0000 0001 2300 695", "hu42117730161111101800000000", "CZ6508000000192000145399"]
VALUES["email"] += ["Bob.Smith", "m" * 90]
INVALID = {"iban": ["DE88 3704 0044 0532 0130 00", "XX89370400440532013000"], "ip": ["256.1.1.1", "01.2.3.4"], "date": ["2021-02-29", "31.04.2020", "13/13/2020", "1800-01-01"],
           "ssn": ["000-45-6789", "666-45-6789", "900-45-6789", "123-00-6789", "123-45-0000"], "card": ["4041894974608794", "0000000000000000"]}


@pytest.mark.parametrize("kind", list(VALUES))
def test_format_validity_and_way_back(kind):
    for value in VALUES[kind]:
        new = I.pseudonym(kind, value, KEY)
        shape = lambda s: "".join("9" if c.isdigit() else c if not c.isalpha() else "a" for c in s)
        assert new is not None and I.pseudonym(kind, new, KEY) is not None, value
        assert I.pseudonym(kind, new, KEY, back=True) == value
        if kind not in ("ip", "ipv6"):  # a month's name may be longer
            assert re.sub("a+", "a", shape(new)) == re.sub("a+", "a", shape(value)) and (kind == "date" or len(new) == len(value))
        assert I.pseudonym(kind, value, b"another") != new or len(value) < 3


def test_invalid_values_stay():
    for kind, values in INVALID.items():
        for value in values:
            assert I.pseudonym(kind, value, KEY) is None, value
            assert I.replaced(f"see {value} here", KEY)[0] == f"see {value} here"


def test_different_values_get_different_pseudonyms():
    rng = random.Random(0)
    for kind, make in (("card", lambda: card("4" + "".join(rng.choice("0123456789") for _ in range(14)))), ("ip", lambda: ".".join(str(rng.randrange(256)) for _ in range(4))),
                       ("phone", lambda: f"+1 ({rng.randrange(200, 1000)}) {rng.randrange(200, 1000)}-{rng.randrange(10_000):04d}")):
        values = {make() for _ in range(300)}
        assert len({I.pseudonym(kind, v, KEY) for v in values}) == len(values)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from([v for vs in VALUES.values() for v in vs] + ["a.b@x.org", "1234567"])), max_size=8))
def test_text_around_values_is_kept(parts):
    text = " ".join(parts).replace("\ud800", "")
    new, counts = I.replaced(text, KEY)
    if not counts:
        assert new == text


def test_documents(spark):
    rows = awkward() + [row(900, "mail jo@a.example.com or +1 (988) 555-2485, card 4041894974608795"), row(901, "card 4041894974608795."), row(902, "jo@b.example.com")]
    got = {r["doc_id"]: r for r in I.pseudonymised(frame(spark, rows), KEY).collect()}
    new = I.pseudonym("card", "4041894974608795", KEY)
    assert got[900]["n_replaced"] == 3 and new in got[900]["text"] and got[901]["text"] == f"card {new}."
    assert got[902]["text"].endswith("@b.example.com") and got[902]["text"][:3] in got[900]["text"]
    assert got[1]["text"] is None and got[2]["text"] == "" and got[14]["n_replaced"] == 0
    back = {r["doc_id"]: r["text"] for r in I.pseudonymised(I.pseudonymised(frame(spark, rows), KEY), KEY, back=True).collect()}
    assert back[900] == rows[-3][1] and back[901] == rows[-2][1]
    assert I.pseudonymised(empty(spark), KEY).count() == 0


PLAIN = ["12", "123", "1234", "12/27", "7", "2020", "BIC COBADEFFXXX", "12345678"]


@pytest.mark.parametrize("kind", list(VALUES))
def test_values_beside_other_values_and_numbers(kind):
    values = [(k, v + "@x.org" if k == "email" else v) for k, vs in VALUES.items() for v in vs]
    alone = {v: I.replaced(v, KEY)[0] for _, v in values}
    for v in [v for k, v in values if k == kind]:
        assert alone[v] != v or v.startswith("x@"), v
        for other in [v for _, v in values] + PLAIN:
            for text, want in ((f"{v} {other}", f"{alone[v]} {alone.get(other, other)}"), (f"{other} {v}", f"{alone.get(other, other)} {alone[v]}")):
                assert I.replaced(text, KEY)[0] == want, text
                assert I.replaced(want, KEY, back=True)[0] == text, text


def test_values_inside_failed_matches():
    phone, ip = "+1 (826) 555-4081", "190.137.223.204"
    assert I.replaced(f"{phone} {ip}", KEY)[0] == f"{I.pseudonym('phone', phone, KEY)} {I.pseudonym('ip', ip, KEY)}"
    for text, value in (("4111111111111111 12/27", "4111111111111111"), ("12 4111 1111 1111 1111 123", "4111 1111 1111 1111"), ("99 41111111 11111111", "41111111 11111111")):
        assert I.replaced(text, KEY)[0] == text.replace(value, I.pseudonym("card", value, KEY))
    assert I.replaced("FR12 DE89370400440532013000 BIC X", KEY)[0] == f"FR12 {I.pseudonym('iban', 'DE89370400440532013000', KEY)} BIC X"
    assert I.replaced("+442079460958", KEY)[0].startswith("+44")


def test_slash_dates_of_every_day():
    days = [datetime.date(1999, 1, 1) + datetime.timedelta(k) for k in range(366)] + [datetime.date(2096, 2, 29), datetime.date(1900, 1, 31), datetime.date(2099, 12, 31)]
    for form in ("%d/%m/%Y", "%m/%d/%Y"):
        late = [d.strftime(form) for d in days if d.day > 12]
        new = [I.pseudonym("date", d, KEY) for d in late]
        assert len(set(new)) == len(late) and all(datetime.datetime.strptime(x, form).day > 12 for x in new)
        assert [I.pseudonym("date", x, KEY, back=True) for x in new] == late
    assert I.replaced("on 31/12/1999", KEY)[1] == I.replaced("on 12/30/2001", KEY)[1] == {"date": 1}


#: One value in many written forms.
SAME = {
    "phone": ["(826) 555-4081", "+1 826 555 4081", "+1 (826) 555-4081", "826-555-4081", "826.555.4081", "+1-826-555-4081"],
    "trunk": ["+44 20 7946 0958", "+44 (0)20 7946 0958", "+442079460958", "+44 020 7946 0958"],
    "date": ["2001-12-30", "30.12.2001", "30/12/2001", "12/30/2001", "30 December 2001", "December 30, 2001", "30 Dec 2001", "DEC 30 2001"],
    "early": ["2001-05-03", "2001-5-3", "3.5.2001", "03.05.2001", "3/5/2001", "03/05/2001", "3 May 2001", "May 3, 2001"],
    "email": ["bob.smith", "Bob.Smith", "BOB.SMITH"],
    "iban": ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "de89370400440532013000"],
    "ipv6": ["2001:db8::ff00:42:8329", "2001:0db8:0000:0000:0000:ff00:0042:8329", "2001:DB8:0:0:0:FF00:42:8329"],
}


def value_of(kind, s):
    """What a written form stands for, found without the module."""
    if kind in ("phone", "trunk"):
        d = "".join(c for c in s if c.isdigit())
        return d[-10:]
    if kind in ("date", "early"):
        for form in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y", "%d %B %Y", "%B %d, %Y", "%d %b %Y", "%b %d %Y"):
            try:
                return datetime.datetime.strptime(s, form).date()
            except ValueError:
                pass
    return ipaddress.ip_address(s) if kind == "ipv6" else s.replace(" ", "").lower()


@pytest.mark.parametrize("kind", list(SAME))
def test_equal_values_in_all_forms_stay_linked(kind):
    name = {"trunk": "phone", "early": "date"}.get(kind, kind)
    new = [I.pseudonym(name, s, KEY) for s in SAME[kind]]
    assert None not in new and len({value_of(kind, s) for s in SAME[kind]}) == 1
    assert len({value_of(kind, s) for s in new}) == 1 and value_of(kind, new[0]) != value_of(kind, SAME[kind][0])
    assert [I.pseudonym(name, s, KEY, back=True) for s in new] == SAME[kind]


def test_every_planted_value_is_replaced_and_comes_back():
    """Values between words, in all forms; a slow look lists what must not be left."""
    rng = random.Random(8)
    forms = [(k, s + "@mail.example.org" if k == "email" else s) for k, vs in {**VALUES, **SAME}.items() for s in vs if s != "x"]
    for _ in range(120):
        planted = rng.sample(forms, 6)
        text = "".join(f"{rng.choice(['see', 'Call:', 'on', 'ref', 'w17', 'x,'])} {s}{rng.choice(['', ',', ' and', '; ok', ')'])} " for _, s in planted)
        new, counts = I.replaced(text, KEY)
        assert sum(counts.values()) == 6, (text, counts)
        assert not [s for _, s in planted if s.split("@")[0] in new.replace("@mail.example.org", "") and len(s) > 8], (text, new)
        assert I.replaced(new, KEY, back=True)[0] == text


def test_no_letter_of_a_long_address_stays():
    new = I.pseudonym("email", "m" * 90, KEY)
    assert new[:6] != "mmmmmm" and len(set(new)) > 10 and I.pseudonym("email", "z" + "q" * 59, KEY)[:2] != "zq"


def test_dates_are_permuted_within_their_class():
    for days in I.DAYS.values():
        some = days[::97]
        new = {I.pseudonym("date", datetime.date.fromordinal(d).isoformat(), KEY) for d in some}
        assert len(new) == len(some) and {datetime.date.fromisoformat(x).toordinal() for x in new} <= set(days)


def test_times_and_versions_are_no_values():
    for text in ("at 12:30:45", "v1.2.3", "a::b", "::1", "10:20", "std::vector", "1/2", "13/13/2001", "99 May 2001", "555-0100", "126-555-4081"):
        assert I.replaced(text, KEY) == (text, {})
