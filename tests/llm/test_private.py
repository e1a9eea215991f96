"""Base spans against plain patterns; added spans and redaction by example."""

import hashlib
import random
import re

from partflow.llm import private


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text):
    found = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(part) <= 255 for part in m.group().split("."))]
    for place, kind, pattern, low, high in ((2, "card", r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                found.append((m.start(), place, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def base_of(text):
    return [f"{kind}:{start}:{end}" for start, end, kind in private.spans_of(text) if kind in private.BASE_KINDS]


def test_random_texts():
    chance = random.Random(9)
    for _ in range(20_000):
        text = "".join(chance.choice(chance.choice(["0123456789", "@.+- ()", "ab@.é٣", "0123456789."])) for _ in range(chance.randint(0, 40)))
        assert base_of(text) == base_spans(text), text


def test_examples():
    assert base_of("a@b.c@d.e 1.2.3.4.5.6.7.8 4111 1111-1111 1111") == base_spans("a@b.c@d.e 1.2.3.4.5.6.7.8 4111 1111-1111 1111")
    kinds = {kind for _, _, kind in private.spans_of(
        "IBAN: DE89370400440532013000, SSN 078-05-1120, account no. 12345678, ftp://me:pass@host/x")}
    assert kinds == {"iban", "ssn", "account", "login"}
    assert not private.spans_of("IBAN: DE00370400440532013000; SSN pending; on account of 12 things; http://host:80/")


def test_long_texts_are_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" * 100_000, "@" * 100_000):
        private.spans_of(text)


def test_whole_table(odd_docs, odd_rows):
    rows = private.find_private(odd_docs).collect()
    wanted = sorted((str(doc_id), hashlib.sha256(",".join(base_spans(text or "")).encode()).hexdigest()) for doc_id, text, _ in odd_rows)
    assert sorted((str(row.doc_id), row.base_sha256) for row in rows) == wanted
    assert sum(row.n_email for row in rows) == sum(row.n_phone for row in rows) == 1
    assert private.find_private(odd_docs.where("false")).count() == 0


def test_redact(odd_docs):
    rows = private.redact(odd_docs)
    assert rows.columns == odd_docs.columns
    assert rows.where("text = 'Mail me: [EMAIL] or [PHONE]'").count() == 1
    assert rows.where("text is null").count() == odd_docs.where("text is null").count()
