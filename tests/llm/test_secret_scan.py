"""Secret scan against brute force with Python's regular expressions."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from minewright.llm import secret_scan as S

SCHEMA = "doc_id long, text string, kind int, spans string, n_hex long"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCOUNT = re.compile(r"""((?i:client_?id|account_?id|user_?name|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", re.ASCII)


def spans(text, link=200):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    base = sorted(found)
    weak = [
        (m.start(), 3, m.end())
        for m in re.finditer("[A-Za-z0-9+/]{32,}", text)
        if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])
    ]
    weak += [(m.start(), 4, m.end()) for m in ACCOUNT.finditer(text) if len(m[2]) >= 3]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(S.ENDPOINT, text)]
    weak = [w for w in weak if not any(b[0] < w[2] and w[0] < b[2] for b in base)]
    breaks = [m.start() for m in re.finditer(r"\n[\x20\x09\r]*\n", text)]
    parts = base + weak

    def near(part, kinds):
        def scope(start):
            return sum(x <= start for x in breaks)

        return any(p[1] in kinds and abs(p[0] - part[0]) <= link and scope(p[0]) == scope(part[0]) for p in parts)

    linked = []
    for part in weak:
        has_id, has_secret = near(part, (1, 4)), near(part, (0, 2, 3))
        if (has_id, has_secret, has_id and has_secret)[part[1] - 3]:
            linked.append(part)
    return base, sorted(base + linked)


def written(parts):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in parts)


def test_spans_equal_brute_force(spark):
    draw = random.Random(4)
    pieces = [
        "token = \"abcdef1\"", "TOKEN:short", "Passwd='a.b-c/d+e_f'", "api_key=token:abcdefgh", "apikey  =  xyzxyz", "secret=\nabcdef",
        "AKIA" + "A1" * 8, "AKIA" + "B" * 7, "xAKIAAKIA" + "C2" * 10, "0123456789abcdef" * 2, "deadbeef", "é0123456789abcdef01234567é",
        "aB3" * 11, "aB3/" * 9, "abc" * 12, "login: root", "user_name=\"al\"", "clientId=app.01@x", "https://h.example:8080/p?q", "jdbc:pg://db/1",
        "ftp://", "\n\n", "\n \t\n", "\n", "prose words here " * 8, "語😀", "ſecret=abcdefgh", "toKen=abcdefgh", "x" * 150,
    ]
    data = [(i, draw.choice([" ", "", "\n"]).join(draw.choice(pieces) for _ in range(draw.randint(1, 14)))) for i in range(600)]
    data += [(700, None), (701, ""), (None, "token=abcdefg"), (None, None), data[3], data[3]]
    data += [(702, "login: meg aB3" + "aB3" * 20 + " https://a.b " * 30_000), (703, "token=abcdef " * 20_000), (704, "\n\n" * 20_000)]
    docs = spark.createDataFrame([(*r, 1, "s", 2) for r in data], SCHEMA).repartition(4)
    got = S.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "n_linked", S.written(F.col("base_spans")), S.written(F.col("spans")))
    wanted = Counter()
    for doc_id, text in data:
        if doc_id == 702:  # every endpoint within reach of the account and the token
            continue
        base, every = spans(text)
        counts = Counter(k for _, k, _ in base)
        wanted[(doc_id, counts[0], counts[1], counts[2], len(every) - len(base), written(base), written(every))] += 1
    rows = [tuple(r) for r in got.collect()]
    assert Counter(r for r in rows if r[0] != 702) == wanted
    far = next(r for r in rows if r[0] == 702)
    assert far[6].startswith("account:0:10,token:11:") and far[4] == 2 + sum("endpoint" in s for s in far[6].split(","))
    assert any("token:" in w[6] and w[4] for w in wanted) and any("endpoint:" in w[6] for w in wanted)
    assert S.scan(docs.limit(0)).count() == 0


def test_weak_parts_alone_are_no_secrets(spark):
    token = "aB3" * 12
    texts = [token, "login: root", "https://a.example/x", f"login: root\n\n{token}", f"login: root\n{token} https://a.example/x", "a " * 150 + token]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r[1] for r in S.scan(docs).select("doc_id", S.written(F.col("spans"))).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "", 4: "account:0:11,token:12:48,endpoint:49:68", 5: ""}


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = S.scan(docs)._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "InPandas" not in plan and "Python" not in plan
