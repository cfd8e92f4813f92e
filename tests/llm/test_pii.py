import hashlib
import itertools
import random
import re
import time

from pyspark.sql import functions as F

from feedlake.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m))
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


def texts():
    rnd = random.Random(9)
    bits = [
        "é", "😀", " ", "\n", "a@b.c_d@e.f", "x.y@mail.example.com", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "4111 1111 1111 1111",
        "4111-1111-1111-1112", "5500005555555559", "+1 (389) 555-5010", "+49 30 1234567", "+1+1+12", "12", "7", "-", "..", "@", "+",
        "(555) 123-4567", "joe [at] site [dot] org", 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"', "word", "3782 822463 10005",
    ]
    made = ["".join(rnd.choice(bits) + rnd.choice(["", " ", ", "]) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    long = ["9" * 30_000, "a." * 10_000 + "@", "a@b" + ".c" * 10_000, "1 " * 10_000, "1." * 10_000, "+1" + " (" * 10_000]
    return [*made, *long, None, "", " "]


def test_base_spans_equal_brute_force_and_stay(docs_of):
    sample = texts()
    rows = {r.doc_id: r for r in pii.report(docs_of(list(enumerate(sample)))).collect()}
    assert len(rows) == len(sample)
    for i, text in enumerate(sample):
        want = brute_base(text)
        got = rows[i]
        assert got.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.BASE_KINDS]
        assert set(want) <= set(got.spans.split(",")) | {""}


def test_running_results_equal_plain_ones(spark):
    rnd = random.Random(4)
    arrays = [[rnd.randint(0, 50) for _ in range(n)] for n in (0, 1, 2, 255, 256, 257, 1000)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<int>")
    got = df.select("i", pii.running(F.col("a"), lambda x, y: x + y).alias("sum"), pii.running(F.col("a"), F.greatest).alias("top"))
    for r in got.collect():
        assert r["sum"] == list(itertools.accumulate(arrays[r.i]))
        assert r.top == list(itertools.accumulate(arrays[r.i], max))


def test_spans_free_of_base_spans_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(200):
        spans = lambda n: [("k", s, s + rnd.randint(1, 9), "m", "", "") for s in (rnd.randint(0, 60) for _ in range(n))]
        rows.append((i, sorted(spans(rnd.randint(0, 6))), spans(rnd.randint(0, 12))))
    df = spark.createDataFrame(rows, f"i int, base {pii.SPAN}, other {pii.SPAN}")
    for r in df.select("i", pii._free(F.col("other"), F.col("base")).alias("free")).collect():
        _, base, other = rows[r.i]
        want = [x for x in other if not any(b[1] < x[2] and x[1] < b[2] for b in base)]
        assert sorted(map(tuple, r.free)) == sorted(want)


def test_replacement_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(60):
        text = "".join(rnd.choice("ab é😀\n") for _ in range(rnd.choice([0, 5, 1023, 1024, 1025, 5000])))
        spans = sorted((s, min(len(text), s + rnd.choice([1, 3, 2000])), rnd.choice(pii.KINDS)) for s in (rnd.randrange(len(text)) for _ in range(rnd.randint(1, 30)))) if text else [(0, 0, "ip")]
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, "i int, text string, spans array<struct<s:int,e:int,kind:string>>")
    for r in df.select("i", pii._replaced(F.col("text"), F.col("spans")).alias("out")).collect():
        _, text, spans = rows[r.i]
        at, want = 0, ""
        for s, e, kind in spans:
            want += text[at:s] if s > at else ""
            want += "" if s < at else f"[{kind.upper()}]"
            at = max(at, e)
        assert r.out == want + text[at:]


def test_many_spans_take_time_in_proportion(docs_of):
    def seconds(n):
        docs = docs_of([(1, "a@b.cc " * n)]).cache()
        docs.count()
        start = time.perf_counter()
        assert pii._spans_of(docs, "text", "base", "loose").select(F.size("base").alias("n")).first().n == n
        assert pii.redact(docs).select(F.length("text").alias("n")).first().n == 8 * n
        assert pii.report(docs).first().n_email == n
        return time.perf_counter() - start

    seconds(1000)
    some, more = seconds(50_000), seconds(200_000)
    assert more < 2.3**2 * max(some, 2.0)  # two doublings


def test_added_spans_are_secrets_and_spelt_out_not_bad_checksums(docs_of):
    clean = [(i, "plain words without numbers") for i in range(50)]
    planted = [(100 + i, f"my token = \"f33e61083db5dbdf4bd2369d2f80176e57f7fda{i}\" and 4111 1111 1111 1112 there") for i in range(9)]
    base = [(200 + i, f"card 4111 1111 1111 1111 or mail joe{i}@site.org now") for i in range(20)]
    rows = {r.doc_id: r.spans for r in pii.report(docs_of(clean + planted + base)).collect()}
    assert all(rows[i] == "" for i, _ in clean)
    assert all("secret:3:" in rows[i] and "card" not in rows[i] for i, _ in planted)


def test_redaction_replaces_only_spans(docs_of):
    docs = docs_of([(1, "é mail joe@site.org, ip 1.2.3.4."), (2, "clean"), (3, None), (3, None), (None, "")])
    docs = docs.withColumnRenamed("lang", "spans").withColumnRenamed("source", "_pii_base")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.text) for r in out.collect()) == ["", "None", "None", "clean", "é mail [EMAIL], ip [IP]."]
    assert pii.redact(docs.limit(0)).collect() == []
    assert pii.report(docs.limit(0)).collect() == []


def test_estimation_finds_the_unreliable_labeler():
    # labelers 1 and 2 agree with the truth, labeler 3 votes at random
    patterns = {}
    for truth, n in ((1, 300.0), (0, 700.0)):
        for noise in (0, 1):
            patterns["k", truth, truth, noise] = n / 2
            patterns["k", truth, 1 - truth, noise] = n / 40
    post = pii.estimate(patterns)
    assert post["k", 1, 1, 0] > 0.9 and post["k", 0, 0, 1] < 0.1
    weights = pii.train({(*p, 0, 0, 0, 0): n for p, n in patterns.items()}, {p + (0,): v for p, v in post.items()})
    assert weights["k", "shape", 1] > 1 and weights["k", "shape", 0] < -1
    assert abs(weights["k", "context", 1]) < 0.5


def test_main_path_has_no_python(docs_of):
    spans = pii._spans_of(docs_of([(1, "a@b.cc")]), "text", "base", "loose")
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
