"""Fill-in-middle against brute force over code points."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from minewright.llm import fim

SCHEMA = "doc_id long, text string, n long, form string, output string"


def cut(doc_id, text, unit, seed, fim_percent, spm_percent):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_percent:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm_percent:
        return (doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


@pytest.fixture(scope="module")
def data():
    draw = random.Random(11)
    alphabet = ["a", "b", "é", "語", "😀", "\n", "\n", " ", "<", "P", "S", "M", ">", "\r", " "]
    out = [(i, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60)))) for i in range(200)]
    out += [(200, None), (201, ""), (202, "\n\n\n"), (203, "no break"), (204, "a<M>b\nc"), (None, "x\ny\nz\n"), (None, None)]
    out += [out[5], out[5], (205, "line é\n" * 40_000), (206, "😀" * 50_000), (207, "<\nP>\n<S\n>")]
    return [(i, t, 5, "f", "o") for i, t in out]


@pytest.mark.parametrize(("unit", "seed", "fim_percent", "spm_percent"), [("line", 7, 100, 50), ("char", 3, 70, 20)])
def test_forms_and_round_trip(spark, data, unit, seed, fim_percent, spm_percent):
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    made = fim.transform(docs, seed=seed, unit=unit, fim_percent=fim_percent, spm_percent=spm_percent)
    got = fim.with_restored(made).collect()
    wanted = Counter(cut(i, t, unit, seed, fim_percent, spm_percent) for i, t, *_ in data)
    assert Counter(tuple(r)[:6] for r in got) == wanted
    assert Counter((r.doc_id, r.restored) for r in got) == Counter((i, t or "") for i, t, *_ in data)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        fim.transform(spark.createDataFrame([], SCHEMA), unit="word")


def test_index_converts_every_cut_both_ways():
    text = "aé語😀b" * 30 + "plain tail"
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fim.CharIndex(raw)
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == cuts).all() and (index.to_chars(cuts) == chars).all()
    assert len(index.at) == 90 and len(fim.CharIndex(np.frombuffer(b"ascii only", np.uint8)).at) == 0


def test_slice_of_a_sliced_array():
    part = fim.Slice(pa.array(["zz\n", "é\nb", None, "", "c\n"]).slice(1, 4))
    breaks, units = part.lines()
    assert units.tolist() == [2, 0, 0, 1]
    assert part.line_cuts(breaks, np.array([1, 0, 0, 1])).tolist() == [3, 4, 4, 6]
