import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tarnwork.llm import pii

KINDS = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    spans = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(KINDS.items()) for m in p.finditer(text or "") if valid(k, m.group()))
    return [sum(s[3] == k for s in spans) for k in KINDS], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    parts = ["a.b@c.de", "x@y.z.w_d@e.f", "+1 (017) 555-7713", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.3.255", "4111 1111 1111 1111", "4845168114407329", "9" * 14, "0" * 20, "+1", "+12345678901234567", "é😀", "DE89370400440532013000", "call 555-1234 now", " ", "\n", ".", "@", "-", "a@b..c", "%+@x-.y-"]
    return ["".join(r.choice(parts) + r.choice([" ", "", "\n", ","]) for _ in range(r.randint(0, 9))) for _ in range(600)] + [None, "", "a@b.c " * 700, "1" * 50_000, "a" * 50_000 + "@b.c", "+1" + " " * 20_000]


def test_base_spans_equal_the_plain_patterns(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest(df).collect():
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute(texts[r.doc_id])


def test_method_adds_confirmed_spans_only(spark):
    rows = ["pay to DE89 3704 0044 0532 0130 00 now", "pay to DE88 3704 0044 0532 0130 00 now", 'token = "ede43f42c939b6405768150e0411590525cf881a"', "commit ede43f42c939b6405768150e0411590525cf881a", "call 555-1234", "part 555-1234", "my ssn is 123-45-6789", "x 123-45-6789", "+1 (017) 555-7713 phone"]
    got = [r.spans for r in pii.digest(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["iban:7:34", "", "secret:9:49", "", "local_phone:5:13", "", "ssn:10:21", "", "phone:0:17"]


def extra_brute(text):
    """Spans of the further kinds but IBANs, with 40 characters of the whole text on either side as context."""
    out, base = [], [m.span() for k, p in KINDS.items() for m in p.finditer(text) if valid(k, m.group())]
    for kind in ("secret", "local_phone", "ssn"):
        prior, up, down = pii.CONTEXT_WORDS[kind]
        for m in re.finditer(pii.PATTERNS[kind], text):
            near = (text[max(0, m.start() - 40) : m.start()] + " " + text[m.end() : m.end() + 40]).lower()
            score = prior + 0.4 * bool(re.search(up, near)) - 0.3 * bool(re.search(down, near))
            if score >= 0.5 and not any(a < m.end() and m.start() < b for a, b in base):
                out.append((m.start(), pii.EXTRA.index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x[-1] for x in sorted(out)]


def test_context_reaches_across_neighbouring_matches(spark):
    key = "ede43f42c939b6405768150e0411590525cf881a"
    rows = ["call 555-1234 or 555-9876", "ssn 123-45-6789, 987-65-4321", "555-1234, 555-2345, 555-3456 and 555-4567 are mobile", "call 555-1234 555-9876 order", f"keys: token {key[:32]} {key[1:33]}", "call " + "555-1234;" * 6, "é😀 ssn " + "123-45-6789 " * 5, "call " + "x" * 41 + " 555-1234 555-2345"]
    r = random.Random(8)
    parts = ["call", "order", "part", "ssn", "token", "commit", "555-1234", "555-123-4567", "123-45-6789", key[:32], "é😀", "word", "x" * 30, "y" * 90]
    rows += ["".join(r.choice(parts) + r.choice([" ", ", ", "\n"]) for _ in range(r.randint(2, 14))) for _ in range(300)] + ["call " + "555-1234, " * 5_000]
    got = {x.doc_id: x.spans for x in pii.digest(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got[0] == "local_phone:5:13,local_phone:17:25" and got[1] == "ssn:4:15,ssn:17:28" and got[3] == ""
    for i, t in enumerate(rows):
        assert [s for s in got[i].split(",") if s.split(":")[0] in pii.EXTRA] == extra_brute(t), t[:200]
    assert pii.redact(spark.createDataFrame([(1, rows[1])], "doc_id long, text string")).first().text == "ssn [SSN], [SSN]"


def test_redaction_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "é a@b.c 1.2.3.4!", "s", 1), (2, None, "s", 1), (2, "clean", "s", 1)], "doc_id long, text string, spans string, __spans int")
    got = pii.redact(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text or "-") for r in got.collect()) == [(1, "é [EMAIL] [IP]!"), (2, "-"), (2, "clean")]
    assert pii.digest(df.limit(0)).count() == 0


def redact_brute(text, spans):
    """Groups of overlapping spans, each replaced by the first one's kind."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def test_redaction_of_any_text_and_overlaps(spark, texts):
    r = random.Random(11)
    pads = ["😀" * 255, "é" * 256, "x" * 257 + " ", "\n" * 300, "z" * 10 + " ", ""]
    long = ["".join(r.choice(pads) + r.choice(["a.b@c.de ", "1.2.3.4 ", "1.2.3.4@5.6.7.8 ", "+1 (017) 555-7713 "]) for _ in range(n)) for n in (1, 2, 3, 50, 127, 128, 129, 3_000)]
    rows = [t for t in texts if t] + long + ["a@b.c " * 9_000, "1.2.3.4@5.6.7.8", "plain"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(8)
    got = pii.find_spans(df, "text", "found").withColumn("new", pii.redacted(F.col("text"), F.col("found"))).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.new == redact_brute(x.text, x.found), x.text[:100]


def test_groups_of_given_spans(spark):
    made = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"
    r = random.Random(12)
    rows = []
    for _ in range(200):
        text = "".join(r.choice("aé😀\n") for _ in range(r.randint(1, 1_200)))
        at = sorted(r.randrange(len(text)) for _ in range(r.randint(0, 300)))
        rows.append((text, [(a, 0, r.randint(a + 1, min(len(text), a + r.choice([2, 40, 600]))), r.choice(["email", "ip"]), 1.0) for a in at]))
    df = spark.createDataFrame(rows, f"text string, spans {made}")
    for x in df.withColumn("new", pii.redacted(F.col("text"), F.col("spans"))).collect():
        assert x.new == redact_brute(x.text, x.spans)


def test_runs_without_python(spark):
    df = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.digest(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
