"""Values linked across layouts, secrets of any characters, and a mix that comes from its schedule."""

import datetime
import hashlib
import re

from pyspark.sql import functions as F

from paceline.llm import mixing, pii
from paceline.session import prepare

SF = "/root/testdata/sf0.001"
KEY = "k"


# --- 9: pseudonyms -----------------------------------------------------------------------------


def renamed(spark, texts):
    table = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in pii.pseudonymise(table, KEY).orderBy("doc_id").collect()]


def noise(kind, i, half):
    return hashlib.sha256(f"{KEY}|{kind}|{i}|{half}".encode()).hexdigest()


def moved(text, stream, letters=26):
    out = []
    for at, c in enumerate(text):
        by = int(stream[at * 2 % 61 :][:3], 16)
        for alphabet in ("abcdefghijklmnopqrstuvwxyz"[:letters], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"):
            if c in alphabet:
                c = alphabet[(alphabet.index(c) + by) % len(alphabet)]
                break
        out.append(c)
    return "".join(out)


def feistel(text, kind, letters=26):
    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for i in range(1, 7):
        if i % 2:
            left = moved(left, noise(kind, i, right), letters)
        else:
            right = moved(right, noise(kind, i, left), letters)
    return left + right


def luhn_sum(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))


def card(digits):
    body = feistel(digits[:-1], "card")
    return body + str(-luhn_sum(body + "0") % 10)


def rest_by_97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def iban(bare):
    account = feistel(bare[4:], "iban")
    return f"{bare[:2]}{98 - rest_by_97(bare[:2] + '00' + account):02}{account}"


def day(date):
    start = datetime.date(1800, 1, 1)
    left, right = divmod((date - start).days, 773)
    for i in range(1, 7):
        if i % 2:
            left = (left + int(noise("date", i, right)[:12], 16)) % 189
        else:
            right = (right + int(noise("date", i, left)[:12], 16)) % 773
    return start + datetime.timedelta(days=left * 773 + right)


def test_one_value_in_any_layout_has_one_pseudonym(spark):
    texts = [
        "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111",
        "+1 (212) 555-0123", "(212) 555-0123", "212-555-0123", "212 555 0123",
        "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32",
    ]
    found = renamed(spark, texts)
    bare = [re.sub("[^0-9A-Z]", "", t) for t in found]
    assert bare[0] == bare[1] == bare[2] == card("4111111111111111") and luhn_sum(bare[0]) % 10 == 0
    assert {b[-10:] for b in bare[3:7]} == {feistel("2125550123", "phone")}
    assert bare[7] == bare[8] == iban("DE89370400440532013000") and bare[9] == iban("GB82WEST12345698765432")
    assert all(rest_by_97(b) == 1 for b in bare[7:])
    shapes = lambda texts: [re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)) for t in texts]
    assert shapes(found) == shapes(texts)


def test_one_day_in_any_layout_has_one_pseudonym(spark):
    dates = [datetime.date(2024, 1, 2), datetime.date(1999, 12, 31), datetime.date(1800, 1, 1), datetime.date(2199, 12, 31)]
    layouts = ["%Y-%m-%d", "%d.%m.%Y", "%Y/%m/%d", "%d-%m-%Y", "%Y-%m-%dT10:00:00Z", "%d %B %Y", "%B %d, %Y"]
    texts = renamed(spark, [d.strftime(x) for d in dates for x in layouts])
    for i, date in enumerate(dates):
        new, found = day(date), texts[i * len(layouts) : (i + 1) * len(layouts)]
        assert new != date and found[:5] == [new.strftime(x) for x in layouts[:5]]
        assert found[5] == f"{new.day} {new:%B %Y}" and found[6] == f"{new:%B} {new.day}, {new:%Y}"


def test_one_digit_dates_are_linked_within_their_shape(spark):
    first, second, third = renamed(spark, ["1.2.2024", "1/2/2024", "2024-2-1"])
    d, m, y = first.split(".")
    assert second == f"{d}/{m}/{y}" and third == f"{y}-{m}-{d}" and (d, m, y) != ("1", "2", "2024")


SECRETS = [
    ("password=", "p@ssw0rd!x", " and"), ("api-key: ", "abcdef123456", ""), ("aws_secret_access_key = ", "wJalrXUtnFEMI/K7MDENG", ""),
    ("pwd=", "Tr0ub4dor&3", ", then"), ('"client_secret": "', "a.b-c~d9", '"'), ("token=", "abcdef123", "&id=5"), ("password: ", "hunter2x", ". Next"),
]


def test_secrets_of_any_characters(spark):
    for (lead, secret, tail), new in zip(SECRETS, renamed(spark, [f"so {lead}{secret}{tail}" for lead, secret, tail in SECRETS])):
        assert new.startswith(f"so {lead}") and new.endswith(tail)
        inside = new[len(f"so {lead}") : len(new) - len(tail)]
        hexadecimal = re.fullmatch("[0-9a-f]+", secret)
        assert inside == feistel(secret, "hex" if hexadecimal else "secret", 6 if hexadecimal else 26)
        assert inside != secret and inside[-3:] != secret[-3:]


def test_wrong_ibans_and_days_stay(spark):
    texts = ["DE89 3704 0044 0532 0130 01", "DE88370400440532013000", "31 February 2024", "February 30, 2024", "May 5", "XX12 ABCD EFGH", "in March 2024"]
    assert renamed(spark, texts) == texts


# --- 1: mixing ---------------------------------------------------------------------------------


def test_words_come_from_slots_alone(spark, monkeypatch):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")

    def taken(**options):
        return {r.doc_id: (r.taken, r.first_slot) for r in mixing.words_taken(*mixing.mix(docs, **options)).collect()}

    golden, other = taken(), taken(step=2**0.5 - 1)
    assert {i: t for i, (t, _) in golden.items()} == {i: t for i, (t, _) in other.items()}
    assert golden != other and all((slot is None) == (not t) for t, slot in golden.values())
    whole = mixing.slots
    monkeypatch.setattr(mixing, "slots", lambda *args: whole(*args).filter("slot % 2 = 0"))
    half = taken()
    assert 0.4 < sum(t for t, _ in half.values()) / sum(t for t, _ in golden.values()) < 0.6
    monkeypatch.setattr(mixing, "slots", lambda *args: whole(*args).limit(0))
    assert all(t == (0, None) for t in taken().values())


def test_each_slot_takes_one_block(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    sizes = docs.select("source", mixing.word_count("text").alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = mixing.targets(sizes).cache()
    for block in (7, 256):
        rows = mixing.schedule(shares, block).collect()
        blocks = {r.place: -(-r.quota // block) for r in shares.collect()}
        assert sorted(r.slot for r in rows) == list(range(sum(blocks.values())))
        assert {(r.place, r["rank"]) for r in rows} == {(p, k) for p, n in blocks.items() for k in range(n)}
        # The source of nearly every slot is the one that holds its point.
        stretch = {r.place: (r.lo, r.hi) for r in shares.collect()}
        own = sum(stretch[r.place][0] <= r.slot * mixing.GOLDEN % 1 < stretch[r.place][1] for r in rows)
        assert own >= len(rows) - 4 * len(blocks)
