"""Line groups against all pairs of lines."""

import random
import re

from llm_texts import prose
from partflow.llm import lines
from xxhash import xxh64_intdigest


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mark_of(value):
    """SimHash of the distinct words, bit by bit."""
    if sum(sign.isdecimal() for sign in value) <= 0.2 * len(value) + 1e-9:
        value = re.sub(r"\d", "0", value)
    words = set(re.findall(r"\w+", value) or value.split())
    hashes = [xxh64_intdigest(word.encode(), 42) for word in words]
    return sum(1 << bit for bit in range(64) if 2 * sum(number >> bit & 1 for number in hashes) > len(hashes))


def candidates(a, b):
    """Three of six blocks are equal, and at most eight bits differ."""
    edges = [0, 10, 21, 32, 42, 53, 64]
    blocks = sum(not (a ^ b) >> low & (1 << high - low) - 1 for low, high in zip(edges, edges[1:], strict=False))
    return blocks >= 3 and (a ^ b).bit_count() <= 8


def brute(rows):
    """What stays of every text, by (doc_id, text), and how many links there are."""
    values = {}
    for doc_id, text in sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0)):
        for place, line in enumerate(text.split("\n") if text is not None else []):
            if value := lines.normal(line):
                values.setdefault(value, []).append((doc_id is None, doc_id, place, text))
    spelled = list(values)
    marks = [mark_of(value) for value in spelled]
    parent, links = list(range(len(spelled))), 0

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a in range(len(spelled)):
        for b in range(a):
            longest = max(len(spelled[a]), len(spelled[b]))
            if candidates(marks[a], marks[b]) and min(len(spelled[a]), len(spelled[b])) >= 0.8 * longest:
                if edits(spelled[a], spelled[b]) <= int(0.2 * longest + 1e-9):
                    parent[find(a)] = find(b)
                    links += 1
    groups = {}
    for node, value in enumerate(spelled):
        groups.setdefault(find(node), []).extend(values[value])
    gone = {(doc_id, text, place) for found in groups.values()
            for _, doc_id, place, text in sorted(found, key=lambda at: (at[0], at[1] or 0, at[2]))[1:]}
    return {(doc_id, text): None if text is None else "\n".join(
        line for place, line in enumerate(text.split("\n")) if (doc_id, text, place) not in gone) for doc_id, text in rows}, links


def near_lines():
    """Variants of long lines, far more of one than of the others."""
    chance, rows = random.Random(8), []
    for family, count in ((30, 60), (31, 4), (32, 3)):
        words = prose(family, 60).split()
        for _ in range(count):
            own = list(words)
            own[chance.randrange(60)] = chance.choice(["zz", "yyy", "x1", "x2"])
            rows.append((len(rows) + 100, "Head\n\n" + " ".join(own) + "\n  page 12 of 30\n" + prose(900 + len(rows), 9)))
    return rows


def check(make_docs, rows):
    docs = make_docs([(doc_id, text, "s") for doc_id, text in rows])
    kept = lines.dedupe_lines(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert len(found) == len(rows)
    wanted, links = brute(rows)
    assert sorted((str(row.doc_id), str(row.text)) for row in found) == sorted(
        (str(doc_id), str(wanted[doc_id, text])) for doc_id, text in rows)
    assert all(row.n_chars == (None if row.text is None else len(row.text)) for row in found)
    return links


def test_near_lines(make_docs):
    assert check(make_docs, near_lines()) > 100


def test_odd_rows(make_docs, odd_rows):
    rows = [(doc_id, text) for doc_id, text, _ in odd_rows if doc_id != 11]
    check(make_docs, rows + [(70, "\n\n"), (71, "---"), (72, " --- \n\nOne\r"), (73, "a\n" * 300)])


def test_digits_and_signs_tell_lines_apart(make_docs):
    chance = random.Random(4)
    apart = ["12 34 56", "98 76 54", "a + b", "x * y", "2024-01-01 10:11:12 0001", "1999-12-31 23:59:58 7777", "f(1)", "[9]"]
    apart += [" ".join(f"{chance.randrange(10 ** 6):06}" for _ in range(5)) for _ in range(200)]
    near = ["The annual report of the company, page 12 of 30", "the annual report of the company: page 13 of 30",
            "The  annual report of the company, page 14 of 30"]
    rows = [(1, "\n".join(apart)), *enumerate(near, 2)]
    check(make_docs, rows)
    kept = {row.doc_id: row.text for row in lines.dedupe_lines(make_docs([(*row, "s") for row in rows])).collect()}
    assert kept == {1: rows[0][1], 2: near[0], 3: "", 4: ""}


def test_documents(spark, make_docs, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 60")
    check(make_docs, [(row.doc_id, row.text) for row in docs.collect()])


def test_empty_table(odd_docs):
    assert lines.dedupe_lines(odd_docs.where("false")).count() == 0


def test_marks_of_few_and_many_words():
    values = [prose(5, 40), prose(6, 3), "---", "1 2 3", " ".join(f"w{nth}" for nth in range(300)), prose(7, 700)]
    found = lines.marks_of(values, lines.WordHashes())
    assert [int(mark) & (1 << 64) - 1 for mark in found] == [mark_of(value) for value in values]


def test_middle_keeps_the_distance():
    chance = random.Random(9)
    for _ in range(300):
        a = "".join(chance.choice("ab") for _ in range(chance.randrange(12)))
        b = "".join(chance.choice("ab") for _ in range(chance.randrange(12)))
        assert edits(*lines.middle(a, b)) == edits(a, b)
