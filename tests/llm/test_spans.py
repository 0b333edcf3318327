"""Personal data and benchmark passages against plain Python versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from conftest import SF_MID
from shelfcast.llm import decontaminate, pii

EDGES = [None, "", "x", "a@b.c", "a@b.c..x@y.z", "q a@b.cd_x@d.e w", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.4", "01.002.0003.255",
         "4111 1111 1111 1111", "4111-1111-1111-1111 5", "é4111111111111111é", "+1 (555) 123-4567.", "+1((((", "++49 30 1234567890",
         "a." * 4000 + "b@c.d", "1 " * 4000, "a" * 30000, "1" * 30000, "x@" + "a." * 5000 + "b", "\U0001f600 a@b.cc 8.8.8.8",
         "mail me@x.org me@x.org, 10.0.0.1", "9" * 14, "0" * 16, "+" + "1" * 9 + " " + "2" * 3, "a@b", "@b.c", "%+-@-.-"]


def luhn(d):
    return sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def digest(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def brute_terms(texts):
    """Spans of disclosing terms of each text, from the formula: N, n(e), n(t) and n(e, t) are counts of rows."""
    bases = [brute_base(t) for t in texts]
    entities = [{f"{k}:{t[s:e].lower()}" for s, k, e in b} for t, b in zip(texts, bases)]
    holds = [{w.lower() for w in re.findall(r"[^\W\d_]+", t or "")} for t in texts]
    places = []
    for d, (text, base) in enumerate(zip(texts, bases)):
        for s, k, e in base:
            low = max(s - 64, 0)
            for side, off, cut_left, cut_right in ((text[low:s], low, low > 0, False), (text[e:e + 64], e, False, len(text) > e + 64)):
                for m in re.finditer(r"[^\W\d_]+", side):
                    a, b = m.start() + off, m.end() + off
                    if not (cut_left and a == off or cut_right and b == off + 64 or any(x < b and y > a for x, _, y in base)):
                        places.append((d, f"{k}:{text[s:e].lower()}", m[0].lower(), a, b))
    n_e, n_t = Counter(e for s in entities for e in s), Counter(w for s in holds for w in s)
    rows, bodies = defaultdict(set), defaultdict(set)
    for d, e, t, *_ in places:
        rows[e, t].add(d)
        bodies[e, t].add(texts[d])
    out = defaultdict(set)
    for d, e, t, a, b in places:
        info = math.log2(len(texts) / n_e[e])
        share = math.log2(len(texts) * len(rows[e, t]) / (n_e[e] * n_t[t])) / info if info > 0 else 0
        if len(bodies[e, t]) >= 2 and share >= 0.5 - 1e-12:
            out[d].add((a, 4, b))
    return out


def check_pii(spark, texts):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, spans string, row_key int")
    rows = pii.report(docs).collect()
    assert len(rows) == len(texts)
    terms = brute_terms(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest(), (texts[r.doc_id] or "")[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert r.spans == digest(sorted({*base, *terms[r.doc_id]})), (texts[r.doc_id] or "")[:80]
    return terms


def test_pii_edges_and_terms(spark):
    told = [f"Reach {w} Blackwood at bob@corp.example for {w} matters" for w in ("quick", "later", "other")]
    plain = [f"nothing of note here {i}" for i in range(40)]
    terms = check_pii(spark, EDGES + told + plain)
    assert any(terms.values())


def test_pii_counts_entities_without_words_beside_them_and_short_names(spark):
    bare = ["4111 1111 1111 1111"] * 2 + [f"12 4111 1111 1111 1111 {i}" for i in range(30)]
    told = [f"Li Bo 4111 1111 1111 1111 pays {i}" for i in range(2)]
    plain = [f"nothing of note {i}" for i in range(400)]
    texts = told + plain + ["Kim x@y.org"] * 3 + ["say Kim x@y.org"] + bare
    terms = check_pii(spark, texts)
    assert (0, 4, 3) in terms[402]                             # Kim, in different texts
    assert not any(check_pii(spark, plain + ["Kim x@y.org"] * 3).values())   # copies of one text prove nothing


def test_generalised_terms_get_the_class_that_the_corpus_shows(spark, monkeypatch):
    monkeypatch.setattr(pii, "REMOVE", 2.0)
    texts = [f"{i} Anna Berg of Acme GmbH, the BKA clerk, a@b.org" for i in range(3)] + [f"plain {i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert got[0] == ("0 [NAME] [NAME] [WORD] [ORGANISATION] [ORGANISATION], [WORD] [ACRONYM] [WORD], [EMAIL]")
    assert got[10] == texts[10]


def test_pii_whole_table(spark):
    check_pii(spark, [r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("text").collect()])


def test_sanitise_keeps_rows_and_columns(spark):
    rows = [(1, "write a@b.cc or +49 30 1234567890 now", "k"), (None, "ip 1.2.3.4", "k"), (2, None, None), (2, "", "k"), (3, "plain", "k"),
            (1, "write a@b.cc or +49 30 1234567890 now", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans string")
    got = sorted(map(tuple, pii.sanitise(docs).collect()), key=str)
    want = [(1, "write [EMAIL] or [PHONE] now", "k")] * 2 + [(None, "ip [IP]", "k"), (2, None, None), (2, "", "k"), (3, "plain", "k")]
    assert got == sorted(want, key=str)
    assert pii.report(docs.limit(0)).count() == 0 and pii.sanitise(docs.limit(0)).columns == docs.columns


def similar(words, item):
    k, n = min(5, len(item)), len(item)
    size = min(n, len(words))
    if size < k:
        return 0
    want, best = Counter(tuple(item[i:i + k]) for i in range(n - k + 1)), 0
    for w in range(len(words) - size + 1):
        have = Counter(tuple(words[i:i + k]) for i in range(w, w + size - k + 1))
        both = (want & have).total()
        best = max(best, both / (want.total() + have.total() - both))
    return best


def test_decontamination_matches_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}é" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 30, 60])))) for i in range(30)]
    items += [(90, None), (91, "!!"), (92, items[-1][1]), (None, "never seen before at all here")]
    docs = [(0, None), (1, ""), (2, "?"), (3, items[7][1]), (3, items[7][1])]
    for d in range(10, 90):
        words = rng.choices(vocabulary, k=rng.randint(1, 150))
        if d % 2:
            leak = rng.choice([t for i, t in items if i is not None and t and i < 90]).split()
            for _ in range(rng.randint(0, 3)):
                leak[rng.randrange(len(leak))] = rng.choice(vocabulary)
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + "," for w in leak]
        docs.append((d, " ".join(words)))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        for i, item in items:
            item = re.findall(r"\w+", (item or "").lower())
            if item and words and similar(words, item) >= 0.8:
                want[d, i] += 1
    for block in (4096, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
        got = decontaminate.contaminated(frame, bench).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == want
    assert decontaminate.shingle_filter(bench).suspect(items[7][1]) and not decontaminate.shingle_filter(bench).suspect("none of these")
    monkeypatch.setattr(decontaminate, "FILTER_MOST", 64)           # a full filter lets all through and loses nothing
    full = decontaminate.contaminated(frame, bench)
    assert Counter((r.doc_id, r.item_id) for r in full.collect()) == want
    texts = dict(docs)
    for r in got:
        assert r.similarity >= 0.8 and texts[r.doc_id][r.start:r.end]
    clean = decontaminate.decontaminated(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if not any(k[0] == d for k in want))
    assert decontaminate.contaminated(frame.limit(0), bench).count() == 0
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0


def test_a_large_benchmark_takes_few_passes_over_the_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 1000)
    rng = random.Random(5)
    texts = [" ".join(f"v{rng.randrange(4000)}" for _ in range(rng.choice([20, 40]))) for _ in range(10_000)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    rows = [(d, " ".join(f"v{rng.randrange(4000)}" for _ in range(200)), "s") for d in range(400)]
    planted = {d: rng.randrange(10_000) for d in range(0, 400, 40)}
    rows = [(d, f"{t} {texts[planted[d]]} {t[:50]}" if d in planted else t, s) for d, t, s in rows]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, suspect string").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    read, found = [], decontaminate._found
    monkeypatch.setattr(decontaminate, "_found", lambda rows, *rest: read.append(rows.count()) or found(rows, *rest))
    got = decontaminate.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == set(planted.items())
    assert len(read) >= 10 and max(read) <= 20                  # the blocks meet the suspects, not the documents
    clean = decontaminate.decontaminated(docs, bench)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert clean.columns == docs.columns and plan.count(path) <= 1
    assert {r.doc_id for r in clean.collect()} == set(range(400)) - set(planted)
