"""License scan against a plain word-by-word search."""

import random
import re

from shelfcast.llm import licenses

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(doc_id, text):
    """The base columns of one document, phrase by phrase."""
    w = words(text)
    at = [(i, label) for label, phrase in licenses.PHRASES for i in range(len(w))
          if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in at]
    return (doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in at})))


def report(spark, rows):
    rows = [(i, t, 7, "x") for i, t in rows]
    return licenses.report(spark.createDataFrame(rows, "doc_id bigint, text string, row int, words string")).collect()


def test_base_columns_match_brute_force(spark):
    rng = random.Random(5)
    pieces = ["the MIT License", "apache license, version 2", "CC BY-NC", "the", "mit", "license", "cc", "by", "nc", "é",
              "TheKit license", "version 2.0", "-- ", "\n", "İ", "LICENSE version"]
    rows = [(0, None), (1, ""), (2, "the mit"), (3, "the mit license the mit license"), (4, "thé mit license"),
            (5, "the mit license " * 5000), (None, "x cc-by-nc"), (6, "CC BY NC cc by nc"), (6, "CC BY NC cc by nc"),
            (7, "K" * 3), (8, "the mİt license")]
    rows += [(100 + i, " ".join(rng.choices(pieces, k=rng.randint(1, 40)))) for i in range(200)]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in report(spark, rows)), key=str)
    assert got == sorted((brute(i, t) for i, t in rows), key=str)


def test_base_phrases_are_those_of_the_contract(spark):
    rows = [(1, "Under the MIT License."), (2, "the mit license"), (3, "under x the mit license"),
            (4, "see the mit license, under the mit license; apache license version 2")]
    got = {r.doc_id: r for r in report(spark, rows)}
    assert [tuple(got[i][c] for c in COLUMNS[1:]) for i in range(1, 5)] == [
        (4, 1, 0, 0, "mit"), (3, 0, None, None, ""), (5, 0, None, None, ""), (12, 2, 4, 8, "apache-2,mit")]
    assert [got[i].labels for i in range(1, 5)] == ["mit", "mit", "mit", "apache-2,mit"]


def test_base_columns_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in licenses.report(docs).collect()), key=str)
    assert got == sorted((brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sum(r[2] for r in got) > 0


def test_notices_survive_changed_words_and_short_ones_must_be_whole(spark):
    bsd = dict(licenses.NOTICES)["bsd"].split()
    changed = bsd[:9] + ["every"] + bsd[10:]                     # one word replaced
    longer = bsd[:8] + ["very", "many"] + bsd[8:]                # the rest moves by two diagonals
    shorter = bsd[:8] + bsd[9:]
    half = bsd[:8]
    texts = [" ".join(w) for w in (bsd, changed, longer, shorter, half)]
    texts += ["licensed under the gnu general public license version 3", "the gnu general public license",
              "some words " * 50 + " ".join(bsd) + " more" * 30]
    rows = {r.doc_id: r for r in report(spark, list(enumerate(texts)))}
    assert [rows[i].labels for i in range(8)] == ["bsd", "bsd", "bsd", "bsd", "", "gpl-3", "", "bsd"]
    assert rows[0].score == 1.0 and rows[7].score == 1.0
    assert 0.8 <= rows[1].score < 1 and rows[4].score < 0.8
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_places_are_the_words_spanned(spark):
    notice = dict(licenses.NOTICES)["unlicense"]
    docs = spark.createDataFrame([(1, "a b c " + notice + " d"), (2, "the mit license")], "doc_id bigint, text string")
    documents, found = licenses.scan(docs)
    by_doc = {r.doc_id: (r.label, r.first, r.last, r.share) for r in found.join(documents, "row").collect()}
    assert by_doc == {1: ("unlicense", 3, 3 + len(notice.split()) - 1, 1.0), 2: ("mit", 0, 2, 1.0)}


def test_empty_table(spark):
    assert report(spark, []) == []
