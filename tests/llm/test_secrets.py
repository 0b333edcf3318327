"""Secrets against plain Python: base spans by the contract's patterns, links by all pairs."""

import hashlib
import re

from conftest import SF_MID
from shelfcast.llm import secrets

KEY = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"
TEXTS = [None, "", "plain", "password: hunter2x", "PASSWORD = 'abc'", "token=secret=abcdef1", "api_key\"  :  \"Zz9+/=_.-\"",
         "apikey=abcdef token:zz secret=yyyyyy", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 20, "é" + "a" * 24 + "g",
         "f" * 23, "0" * 24 + "G" + "1" * 30, f"client_id=abcd1234 then {KEY}", f"{KEY} alone", "account: somebody alone",
         f"https://db.example/x {'.' * 150} {KEY}", f"https://db.example/x {' ' * 300} {KEY}", "postgres://h/db secret=abcdefg",
         ("user_id=abcd " + KEY + " ") * 300, "password=" + "x" * 100_000, "a" * 100_000, "key: " * 1000, f"tenant=aaaa password=aaaaaa {KEY}"]


def brute(text):
    text, base = text or "", []
    base += [(m.start(), 0, m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(base)


def weak_parts(text, base):
    """Weak parts by walking over the text, one kind after another; those that touch a base span are dropped."""
    text, out, at = text or "", [], 0
    while at < len(text):                                      # key: a run of key characters, then up to two "="
        end = at
        while end < len(text) and (text[end].isascii() and text[end].isalnum() or text[end] in "+/_-"):
            end += 1
        run = text[at:end]
        stop = end
        while run and stop < len(text) and text[stop] == "=" and stop < end + 2:
            stop += 1
        if len(run) >= 20 and any(c.islower() for c in run) and any(c.isupper() for c in run) and any(c.isdigit() for c in run):
            out.append((at, "key", stop))
        at = end + 1
    for name in ("http", "https", "postgres", "postgresql", "mysql", "mongodb", "redis", "amqp"):
        at = text.find(name + "://")
        while at >= 0:
            end = at + len(name) + 3
            while end < len(text) and not text[end].isspace() and text[end] not in "\"'<>":
                end += 1
            if end - at - len(name) - 3 >= 4 and not (at and (text[at - 1].isascii() and text[at - 1].isalnum() or text[at - 1] == "_")):
                out.append((at, "endpoint", end))
                at = end
            at = text.find(name + "://", at + 1)
    low, word = text.lower(), lambda c: c.isascii() and (c.isalnum() or c == "_")
    at = 0
    while at < len(text):
        end = None
        if at == 0 or not word(text[at - 1]):
            for name in ("client", "account", "access", "tenant", "user"):
                for sep in ("", "_", "-"):
                    for tail in ("", "id", "name"):
                        head = name + sep + tail
                        if low.startswith(head, at):
                            p = at + len(head)
                            p += p < len(text) and text[p] in "\"'"
                            p += p < len(text) and text[p] == " "
                            if p < len(text) and text[p] in ":=":
                                p += 1
                                p += p < len(text) and text[p] == " "
                                p += p < len(text) and text[p] in "\"'"
                                stop = p
                                while stop < len(text) and (text[stop].isascii() and text[stop].isalnum() or text[stop] in "_.@-"):
                                    stop += 1
                                if stop - p >= 4:
                                    end = stop
        if end:
            out.append((at, "id", end))
            at = end
        else:
            at += 1
    order = {"id": 3, "key": 4, "endpoint": 5}
    return sorted((s, order[k], e) for s, k, e in out if not any(b[0] < e and b[2] > s for b in base))


def linked(base, weak):
    """The complementary roles in words: see the operator's docstring."""
    secret, identifier, place = {0, 2, 4}, {1, 3}, {5}
    wants = {3: secret, 4: identifier | place, 5: secret}
    return [w for w in weak if any(p[1] in wants[w[1]] and p[0] - w[2] <= 200 and w[0] - p[2] <= 200
                                   and (p[0] >= w[2] or p[2] <= w[0]) for p in base + weak)]


def digest(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    rows = secrets.report(docs).collect()
    assert len(rows) == len(texts)
    extra = 0
    for r in rows:
        base = brute(texts[r.doc_id])
        weak = weak_parts(texts[r.doc_id], base)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)], texts[r.doc_id][:60]
        assert r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert r.spans == digest(sorted(base + linked(base, weak)))
        extra += len(linked(base, weak))
    return extra


def test_secrets_match_brute_force(spark):
    assert check(spark, TEXTS) > 100
    again = spark.createDataFrame([(None, TEXTS[14]), (None, TEXTS[14])], "doc_id long, text string")
    a, b = secrets.report(again).collect()
    assert a == b and "id:" in a.spans and "key:" in a.spans
    assert secrets.report(again.limit(0)).count() == 0


def test_secrets_whole_table(spark):
    check(spark, [r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("text").collect()])


def test_no_text_completes_itself(spark):
    texts = ["the user_id=AbCd1234EfGh5678IjKl is shown", "see https://host.example/AbCd1234EfGh5678IjKlMn",
             "see https://host.example/AbCd1234EfGh5678IjKlMn and user_id=abcd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.report(docs).collect()}
    assert got[0] == "" and got[1] == ""
    assert "key:" in got[2] and "id:" in got[2]               # a key beside another text's identifier


def test_long_weak_parts_are_whole(spark):
    key, rest = "Ab3" * 167, "x" * 480
    texts = [f"client_id=abcd1234 then {key}", f"https://db.example/{rest} {'.' * 150} password=abcdef",
             f"user_id={'u' * 300} {'.' * 150} {KEY}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans.split(",") for r in secrets.report(docs).collect()}
    start = texts[0].index(key)
    assert f"key:{start}:{start + len(key)}" in got[0]
    assert f"endpoint:0:{len('https://db.example/' + rest)}" in got[1]
    assert f"id:0:{len('user_id=') + 300}" in got[2] and [s for s in got[2] if s.startswith("key:")]
