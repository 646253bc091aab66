"""Personal data against plain regular expressions, and the terms that co-occurrence adds."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from shelfcast.llm import pii

#: The contract's patterns, as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [
        (m.start(), rank, m.end(), kind)
        for rank, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "") if passes(kind, m[0])
    ]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def texts():
    rng = random.Random(6)
    parts = ["a.b@c.d", "a@b.c@d.e", "x_@y.z-", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.0004", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "4111111111111111", "+1 (555) 123-4567", "+44 20 7946 0958)", "++1 2", "+1", "12", "é", "日本 ", "\u0001", "$0", "\\1", " ", "\n", ".", "@", "-", "a"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]


def test_base_spans_equal_plain_patterns(spark):
    rows = [*enumerate(texts()), (900, None), (901, ""), (902, "7 " * 3000 + "x@y.z"), (903, "a" * 20_000), (904, "1." * 9000),
            (905, "1" * 20_000), (906, "a.b." * 5000 + "@c.d"), (None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("uid", F.lit("x"))
    got = pii.find_personal_data(docs).collect()
    want = sorted(
        [
            (str(d), *(sum(s[3] == k for s in found) for k in PLAIN), hashlib.sha256(listed(found).encode()).hexdigest(), listed(found))
            for d, t in rows for found in [plain(t)]
        ]
    )
    base = lambda s: ",".join(x for x in s.split(",") if not x.startswith("term"))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, base(r.spans)) for r in got) == want


def revealing():
    rng = random.Random(1)
    filler = ["river", "stone", "green", "about", "window", "seven"]
    rows = [f"{' '.join(rng.sample(filler, 4))} number {i}" for i in range(80)]
    rows += [f"{a} Zanzibarite {b} write to boss@corp.example {a}" for a, b in (("river", "about"), ("stone", "green"), ("green", "seven"))]
    rows += [f"zanzibar is {w}" for w in filler] * 3
    return [(i, t) for i, t in enumerate(rows)]


def test_terms_that_give_an_entity_away_are_found_and_generalised(spark):
    rows = revealing()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    for i, text in rows:
        term = [s for s in out[i].split(",") if s.startswith("term")]
        at = text.find("Zanzibarite")
        words = {text[int(a) : int(b)] for a, b in (s.split(":")[1:] for s in term)}
        assert ("Zanzibarite" in words) == (at >= 0) and words <= {"Zanzibarite", "write"}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all(clean[i] == t for i, t in rows if "@" not in t)
    changed = [clean[i] for i, t in rows if "@" in t]
    assert all("[EMAIL]" in t and "boss" not in t and "Zanzibarite" not in t and "zanz*" in t for t in changed)


def test_one_text_is_no_evidence(spark):
    rows = [(i, "unusual wording beside boss@corp.example") for i in range(5)] + [(i, "other words") for i in range(5, 40)]
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any("term" in r.spans for r in out)


def test_sanitise_keeps_rows_and_columns(spark):
    rows = [(1, "call +1 (555) 123-4567 or 4111111111111111 now", "en", None, 5), (2, None, None, "s", None), (3, "plain", "x", "y", 5), (3, "plain", "x", "y", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(1, "call [PHONE] or [CARD] now", "en", None, 26, 1), *[(*r, 1) for r in rows[1:]]], key=str)
    assert pii.sanitise(docs.limit(0)).count() == 0 and pii.find_personal_data(docs.limit(0)).count() == 0


def test_main_path_is_native(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for out in (pii.find_personal_data(docs), pii.sanitise(docs)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def planted():
    """A name at the head of long texts with an address at their foot, in three forms, and beside other things."""
    rng = random.Random(4)
    filler = [f"{w}{v}" for w in ("river", "stone", "green", "about") for v in ("", "ing", "ed", "er")]
    body = lambda n=8: " ".join(rng.choice(filler) for _ in range(n))
    names = ("Quillfeather met Smythe-Wexcombe", "J.Quillfeather knows Smythe-Wexcombe", "-Quillfeather- and smythe-wexcombe")
    rows = [f"{name} {body(200)} write: {i}@corp.example boss@corp.example" for i, name in enumerate(names)]
    rows += [f"{body()} Quillfeather {body()}", f"{body()} by Smythe-Wexcombe. {body()}"] + [body() for _ in range(400)]
    return [(i, t) for i, t in enumerate(rows)]


def test_revealing_terms_leave_every_document(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert len(clean) == len(rows) and all("[EMAIL]" in clean[i] for i in range(3))
    assert not any(w in t.lower() for t in clean.values() for w in ("quillfeather", "smythe", "wexcombe"))
    assert all(clean[i] == t for i, t in rows[5:])
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    texts = dict(rows)
    held = {i: {texts[i][int(a) : int(b)] for k, a, b in (x.split(":") for x in s.split(",") if x) if k == "term"} for i, s in spans.items()}
    assert held[3] == {"Quillfeather"} and held[4] == {"Smythe", "Wexcombe", "Smythe-Wexcombe"} and not held[5]
    assert all("Quillfeather" in held[i] for i in range(3)) and not any("corp" in w for h in held.values() for w in h)
