"""Text-pipeline operators against brute force on a small table of awkward rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from minewright.llm import (
    blocks,
    byte_bpe,
    chat_format,
    class_lm,
    decontamination,
    host_rules,
    jaccard_join,
    language_id,
    page_text,
    substring_dedup,
    toxicity,
)
from minewright.llm.queries import VOCABULARY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, `key` string, lang_pred string"


def words(text, lower=False):
    text = text or ""
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text) if lower else text)


def shingles(text, size, lower=False):
    w = words(text, lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    lexicon = {
        "en": "the house garden with water under tree walking over morning light Friend".split(),
        "de": "der Garten häuser unter straße über wasser gegangen möchte schön".split(),
    }

    def text(lang, n):
        return " ".join(draw.choice(lexicon[lang]) + draw.choice(["", "", ".", "x", "ly"]) for _ in range(n))

    out = [(i, text("en" if i % 3 else "de", draw.randint(3, 90)), "en" if i % 3 else "de", f"s{i % 4}") for i in range(1, 60)]
    long = text("en", 60)
    copies = long.split()
    for i in range(60, 75):
        near = list(copies)
        near[draw.randrange(60)] = f"new{i}"
        out.append((i, " ".join(near) if i % 2 else long, "en", "s0"))
    out += [(80, None, None, None), (81, "", "en", "s1"), (82, " \t\n ", None, "s1"), (83, "12 34 -- !!", "de", None)]
    out += [(84, "one two three", "en", "s2"), (85, "one two three", "en", "s2"), (86, text("en", 30_000), "en", "s2")]
    out += [(87, "naïve café  x y 😀 <s> \\ [/INST] a\x1cb", "en", "s3"), (None, long, "en", "s0"), (None, None, None, None)]
    out += [out[4], out[4], (88, "again and again\n" * 40, "en", "s3"), (89, "x" * 5000, "en", "s3")]
    return [(*r, len(r[1] or ""), 7, "k", "zz") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(values):
    return Counter(tuple(v) for v in values)


def test_measures_and_base_rules(docs, rows, nothing):
    expected = Counter()
    for doc_id, text, *_ in rows:
        w, text = words(text), text or ""
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        base = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        counts = (sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        expected[(doc_id, len(w), *counts, base)] += 1
    judged = host_rules.judge(docs)
    assert bag(r[:7] for r in judged.collect()) == expected
    assert all(r.kept == (not r.base_failed and not r.host_failed) for r in judged.collect())
    assert host_rules.judge(nothing).count() == 0


def test_host_rates_are_shrunk_and_condemn_bad_hosts(spark):
    good = " ".join(f"word{i}" for i in range(30))
    data = [(i, good if i % 10 else "short", f"h{i % 20}") for i in range(400)]
    data += [(1000 + i, "short" if i else good, "bad") for i in range(50)] + [(2000, "short", "tiny"), (2001, good, "tiny")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    kept = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    assert kept[1000].host_failed and not kept[1000].kept and not kept[1000].base_failed
    assert kept[2001].kept and all(kept[i].kept for i in range(400) if i % 10)


def test_bpe_equals_tiktoken(spark, docs, rows, nothing):
    ranks = byte_bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = own.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected[(doc_id, len(ids), *digests)] += 1
    assert bag(byte_bpe.encode_documents(spark, docs, ranks, public_tokenizers.PATTERN).collect()) == expected
    assert byte_bpe.encode_documents(spark, nothing, ranks, public_tokenizers.PATTERN).count() == 0
    draw = random.Random(1)
    for _ in range(300):
        word = "".join(draw.choice("abcdeéñßthing'12😀") for _ in range(draw.choice([1, 4, 12, 90])))
        assert byte_bpe.encode_word(word.encode(), ranks) == own._encode_single_piece(word)


def test_language_model_counts_and_gain(spark, docs, rows, nothing):
    tokens = [(r[0], [*words(r[1], lower=True), None]) for r in rows]
    held = {i: i is None or crc32(str(i).encode()) % 10 == 0 for i, _ in tokens}
    counts = Counter(t for i, w in tokens if not held[i] for t in w)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, w in tokens:
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in w)
        expected[(i, held[i], len(w), sum(counts[t] > 0 for t in w), total, round(base, 5))] += 1
    got = class_lm.score_documents(spark, docs).collect()
    assert Counter((*r[:5], round(r.base_score, 5)) for r in got) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)
    assert class_lm.score_documents(spark, nothing).count() == 0


def _clustered(spark, docs):
    """Class of every training word, and the mutual information by round."""
    rows = docs.select("doc_id", "text", language_id.in_training(F.col("doc_id"), 10, 0).alias("learn"))
    held, name = class_lm._bucketed(blocks.make_blocks(rows, class_lm._pack, spread=False), 3)
    counts = Counter(w.encode() for r in rows.filter("learn").collect() for w in words(r.text, True))
    top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][: class_lm.CLASSES - 1]
    answers, _, history = class_lm.cluster(spark, held, 4, top)
    found = {}
    for row in blocks.with_answers(held, answers).collect():
        *_, lengths, joined = blocks.expand(row.payload)
        spelled = class_lm._cut(lengths, joined)
        kind, seen = class_lm._kinds(spelled, {a.bucket: a.payload for a in row.answers or ()}, 4, {})
        for w, k, n in zip(spelled, kind.tolist(), seen.tolist()):
            assert n == counts[w] and (k == class_lm.UNKNOWN) == (n == 0) and found.setdefault(w, k) == k
    spark.sql(f"DROP TABLE {name}")
    return found, counts, history


def test_class_scores_by_brute_force(spark, docs, rows):
    kinds, counts, _ = _clustered(spark, docs)
    texts = [([w.encode() for w in words(r[1], True)], r[0] is not None and crc32(str(r[0]).encode()) % 10 != 0) for r in rows]
    moves, sizes = np.zeros((class_lm.STATES, class_lm.STATES)), Counter()

    def path(tokens):
        return [class_lm.END, *(kinds.get(w, class_lm.UNKNOWN) for w in tokens), class_lm.END]

    for tokens, learn in texts:
        if learn:
            sizes.update(kinds[w] for w in tokens)
            for a, b in zip(path(tokens), path(tokens)[1:]):
                moves[a, b] += 1
    n_tokens = sum(counts.values()) + sum(learn for _, learn in texts)
    unknown = min(0.5, max(1e-7, sum(n == 1 for n in counts.values()) / n_tokens))
    log = class_lm.transition_scores(moves.copy(), unknown)
    expected = []
    for tokens, _ in texts:
        steps = path(tokens)
        score = sum(log[a, b] for a, b in zip(steps, steps[1:]))
        expected.append(round(score + sum(math.log10(counts[w] / sizes[kinds[w]]) for w in tokens if counts[w]), 5))
    assert sorted(round(r.score, 5) for r in class_lm.score_documents(spark, docs).collect()) == pytest.approx(sorted(expected), abs=2e-5)


def test_exchange_raises_mutual_information(spark):
    draw = random.Random(8)
    parts = [[f"{kind}{i}" for i in range(60)] for kind in ("noun", "verb", "adj")]
    data = [(i, " ".join(draw.choice(p) for _ in range(30) for p in parts)) for i in range(300)]
    kinds, counts, history = _clustered(spark, spark.createDataFrame(data, "doc_id long, text string"))
    assert history[:-1] == sorted(history[:-1]) and history[-2] > 1.5 * history[0]
    # No class mixes parts of speech: contexts are classes, not chosen words, and no word is without one.
    mixed = {k: {w.decode().rstrip("0123456789") for w in counts if kinds[w] == k} for k in set(kinds.values())}
    assert sum(len(m) == 1 for m in mixed.values()) >= 0.9 * len(mixed)


def test_best_class_by_trying_all():
    """The gain of a move equals the change of the class-bigram likelihood, for a word that is not its own neighbour."""
    draw = np.random.default_rng(4)
    side = class_lm.SIDE
    sums = np.zeros((class_lm.CLASSES, 2 * side))
    sums[:, :] = draw.integers(0, 40, sums.shape)
    context = np.sort(draw.choice(2 * side, 6, replace=False))
    n, home = draw.integers(1, 4, 6), 7
    sums[home, context] += n
    own = int(n[context < side].sum())

    def likelihood(k):
        moved = sums.copy()
        moved[home, context] -= n
        totals = sums[:, :side].sum(1)
        totals[home] -= own
        moved[k, context] += n
        totals[k] += own
        return (moved * np.log(np.maximum(moved, 1))).sum() - 2 * (totals * np.log(np.maximum(totals, 1))).sum()

    got = class_lm.best_classes(np.array([own]), np.array([home]), np.array([6]), context, n, sums)
    assert got[0] == max(range(class_lm.CLASSES), key=likelihood)


def test_transitions_sum_to_one():
    import numpy as np

    moves = np.arange(class_lm.STATES**2, dtype=float).reshape(class_lm.STATES, -1) % 7
    assert np.allclose((10 ** class_lm.transition_scores(moves, 0.01)).sum(1), 1)


def leaks(rows, items):
    sets = {i: shingles(t, 5) for i, t in items}
    out = Counter()
    for doc_id, text, *_ in rows:
        own = shingles(text, 5)
        for i, s in sets.items():
            if s and len(own & s) >= 0.8 * len(s) - 1e-9:
                out[(doc_id, i, len(own & s), len(s))] += 1
    return out


def test_leaks_equal_brute_force(spark, docs, rows, nothing):
    by_id = {r[0]: r[1] for r in rows}
    items = [(i, " ".join(by_id[j].split()[a:b])) for i, (j, a, b) in enumerate([(86, 500, 540), (86, 29_900, 29_960), (60, 0, 25), (5, 1, 8)])]
    items += [(90, "one two three"), (91, None), (92, ""), (93, "not there at all in any text"), (94, " ".join(by_id[86].split()[90:900]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = bag(r[:4] for r in decontamination.find_leaks(spark, docs, bench).collect())
    assert got == leaks(rows, items)
    left = decontamination.drop_leaks(spark, docs, bench)
    hit = {i for i, *_ in got}
    assert left.columns == docs.columns
    assert left.filter("doc_id is not null").count() == sum(r[0] is not None and r[0] not in hit for r in rows)
    assert decontamination.find_leaks(spark, nothing, bench).count() == 0
    assert decontamination.find_leaks(spark, docs, bench.filter("item_id < 0")).count() == 0


def test_toxic_passages_are_found(spark):
    draw = random.Random(3)
    syllables = "the on er at ing ou th re in an".split()

    def text(n, bad):
        w = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n)]
        for _ in range(bad):
            w[draw.randrange(n)] = draw.choice(["horrible", "dreadful", "nastyness"])
        return " ".join(w)

    data = [(i, text(draw.randint(20, 150), 4 if i % 4 == 0 else 0)) for i in range(600)]
    docs = spark.createDataFrame([*data, (None, None), (900, "")], "doc_id long, text string").withColumn("toxic", F.lit(9))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in data] + [(None, 1), (5, None)], "doc_id long, toxic int")
    usable = language_id.in_training(F.col("doc_id"), 3, 1)
    got = toxicity.score(spark, docs, toxicity.train(spark, docs, labels, usable)).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    untaught = toxicity.train(spark, docs, labels.limit(0), usable)
    assert {r.predicted for r in toxicity.score(spark, docs, untaught).collect()} == {0}


def test_toxic_words_spread_over_many_endings(spark, nothing):
    """Three hundred toxic words of ten stems, each in under 3 % of the toxic texts: no single word tells."""
    draw = random.Random(11)
    syllables = "the on er at ing ou th re in an".split()
    stems = ["vrkla", "zmopu", "gwexi", "dlubo", "pfuna", "skjoma", "bzirt", "hruqe", "tchaw", "mwolp"]
    spoilt = [a + "".join(b) for a in stems for b in draw.sample([(x, y, z) for x in syllables for y in syllables for z in syllables], 30)]

    def text(bad):
        w = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.randint(20, 150))]
        for _ in range(bad):
            w[draw.randrange(len(w))] = spoilt[next(turn) % 300]
        return " ".join(w)

    turn = itertools.count()
    data = [(i, text(5 if i % 4 == 0 else 0)) for i in range(1600)]
    seen = Counter(w for i, t in data if i % 4 == 0 for w in set(t.split()) & set(spoilt))
    assert max(seen.values()) < 0.03 * 400
    huge = " ".join([data[1][1]] * 2000) + " " + data[4][1]
    docs = spark.createDataFrame([*data, (5001, huge)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in data], "doc_id long, toxic int")
    usable = language_id.in_training(F.col("doc_id"), 3, 1)
    model = toxicity.train(spark, docs, labels, usable)
    got = {r.doc_id: r for r in toxicity.score(spark, docs, model).collect()}
    assert len(got) == 1601 and 0 <= got[5001].score <= 1
    held = [got[i] for i, _ in data if crc32(str(i).encode()) % 3 == 1]
    bad, good = ([r.predicted for r in held if (r.doc_id % 4 == 0) == k] for k in (True, False))
    assert sum(bad) >= 0.85 * len(bad) and sum(good) <= 0.08 * len(good)
    assert toxicity.score(spark, nothing, model).count() == 0


def test_languages(spark, docs, rows, nothing):
    field = language_id.train(docs, language_id.in_training(F.col("doc_id"), 4, 2))
    got = language_id.identify(spark, docs, field, ("doc_id", "lang", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    known = [r for r in got if r.doc_id and r.doc_id < 60]
    assert sum(r.lang == r.lang_pred for r in known) >= 0.95 * len(known)
    kept = language_id.keep_identified(spark, docs, field)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" for r in got)
    assert {r.lang_pred for r in language_id.identify(spark, docs, language_id.train(nothing, F.lit(True))).collect()} == {"und"}


def test_signs_that_only_look_like_letters():
    for sign in "\u00b2\u00bd\u2460\u2167":
        assert not language_id.has_letter(f"1 {sign} _")
    assert language_id.has_letter("1 \u00b2 é") and not language_id.has_letter("")


def test_partitions_of_tables_of_unknown_size(spark, nothing):
    local = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for table in (local, local.cache(), nothing, local.join(local, "doc_id")):
        assert blocks.partitions_for(table) <= 8
    long = spark.createDataFrame([("x" * 1000,)] * 100, "text string")
    assert blocks.partitions_for(long, 5_000) == 20


def test_forward_backward_equals_enumeration():
    import itertools

    import numpy as np

    draw = np.random.default_rng(2)
    scores, change = draw.random((4, 1, 3)) + 0.1, draw.random((3, 3)) + 0.1
    wanted, total = np.zeros((4, 3)), 0.0
    for path in itertools.product(range(3), repeat=4):
        p = np.prod([scores[t, 0, k] for t, k in enumerate(path)]) * np.prod([change[a, b] for a, b in itertools.pairwise(path)])
        total += p
        for t, k in enumerate(path):
            wanted[t, k] += p
    got, _ = language_id._forward_backward(scores, np.array([4]), change)
    assert np.allclose(got[:, 0], wanted / total)


def cut(rows):
    first = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - 12):
            if doc_id is not None:
                key = tuple(w[i : i + 13])
                first[key] = min(first.get(key, doc_id), doc_id)
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - 12):
            if doc_id is not None and first[tuple(w[i : i + 13])] < doc_id:
                gone |= set(range(i, i + 13))
        yield doc_id, w, [x for i, x in enumerate(w) if i not in gone]


def test_substring_dedup_equals_brute_force(docs, rows, nothing):
    expected = Counter(
        (i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for i, w, kept in cut(rows)
    )
    assert bag(substring_dedup.dedup_substrings(docs).collect()) == expected
    assert substring_dedup.dedup_substrings(nothing).count() == 0


def test_chat_round_trip(spark):
    texts = ["hi", None, "", "</s>[INST] ok [/INST]", "a \\ b", "<<TURN x>> y <</TURN>>", "trail \\", " [/INST] ", "two\nlines "]
    data = [(1, t, ["user", "assistant", "system", None][t % 4], x) for t, x in enumerate(texts * 3)]
    data += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, None, "user", "x"), (3, 1, ">> role", "z")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit(0))
    got = {r.conv_id: r for r in chat_format.digest_conversations(spark, turns).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([(t or -1, r or "", x or "") for c, t, r, x in data if c == conv])
        said = "".join(x for _, r, x in own if r == "assistant")
        full = "".join(f"{r}\n{x}\n" for _, r, x in own)
        rendered = "".join(chat_format.format_turn(r, x)[0] for _, r, x in own)
        at, back = 0, []
        while at < len(rendered):
            role, text, at = chat_format.parse_turn(rendered, at)
            back.append((role, text))
        assert back == [(r, x) for _, r, x in own]
        assert tuple(got[conv]) == (
            conv, len(own), hashlib.sha256(full.encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest(), len(rendered),
        )
    assert chat_format.digest_conversations(spark, turns.limit(0)).count() == 0


def test_common_lines_are_a_longest_common_subsequence():
    draw = random.Random(4)
    for _ in range(200):
        a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = sorted(page_text.common_lines(a, b))
        assert len(got) == best[-1][-1]
        left = iter(b)
        assert all(a[i] in left for i in got)


def test_pages(spark):
    shell = "<html><head><title>t</title></head><body><div>Site name</div>{}<div>All rights</div><footer>f</footer></body></html>"
    data = [
        (1, "http://a.org/x/1", shell.format("<p>First   story &amp; more</p><p>Its <b>b</b>old end</p>")),
        (2, "http://a.org/x/2", shell.format("<p>Second story</p>")),
        (3, "http://b.org/1", "<nav>menu</nav><article><h1>T</h1><p>One<br>two<div class='comments'>no</div><aside>x</aside></article><p>out</p>"),
        (4, None, None), (5, "http://c.org", ""), (6, "http://d.org/1", "<p>alone &lt;3 <script>var x='</p>'</script></p><form>q</form>"),
        (None, "http://d.org/1", "<p>no id"), (2, "http://a.org/x/2", shell.format("<p>Second story</p>")),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit("h"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # pairs are made within a range
    got = Counter((r.page_id, r.text) for r in page_text.extract(spark, pages).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    story = (1, "First story & more Its bold end")
    assert got == Counter([story, (2, "Second story"), (2, "Second story"), (3, "T One two"), (4, ""), (5, ""), (6, "alone <3"), (None, "no id")])
    assert page_text.extract(spark, pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "source, text",
    [
        ("<article><p class='share'>x<p>Body text<p>More</article>", "Body text More"),
        ("<article><p class=share>x<b>y</b></p>Body</article>", "Body"),
        ("<article><ul><li class='ad'>a<ul><li>b</li></ul><li>kept</ul><p>end</article>", "kept end"),
        ("<article><ul><li class='ad'>a<div>c</div></ul><p>end</article>", "end"),
        ("<article><table><tr><td class='ad'>a<td>kept<tr class='promo'><td>x<tr><td>too</table></article>", "kept too"),
        ("<article><table><tr class='ad'><td>a</td><td><table><tr><td>b</table></td></tr><tr><td>kept</table>x</article>", "kept x"),
        ("<article><dl><dt class='ad'>a<dd>kept</dl></article>", "kept"),
        ("<article><p class='share'>x<div>Body</div></article><p>out", "Body"),
        ("<article><div class='social-history'>Kept</div><div class='share-buttons'>x</div><div id='ad-1'>y</div></article>", "Kept"),
        ("<article>Teaser</article><div>A body far longer than the teaser</div>", "Teaser A body far longer than the teaser"),
    ],
)
def test_page_marks(source, text):
    assert page_text.main_text(page_text.lines_of(source), None) == text


def test_teaser_pages_lose_the_lines_of_the_site():
    shell = "<div>Site name and motto</div><article>Teaser</article><div>{}</div>"
    one, two = (page_text.lines_of(shell.format(x)) for x in ("First body, quite long", "Second body, as long"))
    assert page_text.main_text(one, two) == "Teaser First body, quite long"


def linked(rows, size, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, set()).add(shingles(text, size, lower=True))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets} | {None: None}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, docs, rows, nothing, size, percent):
    label = linked(rows, size, percent)
    expected = Counter((r[0], len(shingles(r[1], size, lower=True)), label[r[0]]) for r in rows)
    assert bag(jaccard_join.link_components(spark, docs, shingle=size, percent=percent).collect()) == expected
    assert jaccard_join.link_components(spark, nothing).count() == 0


def test_tree_leaves_every_pair_that_can_link():
    import numpy as np

    draw = np.random.default_rng(1)
    centre = draw.integers(0, 3, (6, jaccard_join.GROUPS))
    points = (centre[draw.integers(0, 6, 300)] + draw.integers(0, 2, (300, jaccard_join.GROUPS))).astype(np.uint8)
    sizes, groups = points.sum(1).astype(np.int64), draw.integers(0, 40, 300)
    got = {tuple(sorted(p)) for x, y, _ in jaccard_join.tree_pairs(points, sizes, groups, 85) for p in zip(x.tolist(), y.tolist(), strict=True)}
    low = np.minimum(points[:, None], points[None]).sum(-1)
    need = jaccard_join.overlap_needed(sizes[:, None], sizes[None], 85)
    fits = (low >= need) & (groups[:, None] != groups[None])
    assert got == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(fits)), strict=True) if i < j}


def test_link_behind_tried_partners_of_larger_bounds_is_found(spark, monkeypatch):
    """One bucket of four equal sizes: only the second and fourth link, the pairs tried before are just under."""
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda docs, shingle: np.zeros(0, np.uint64))
    pool = [f"w{i}" for i in range(6000)]
    hashes = dict(zip(pool, jaccard_join._sets(pa.table({"text": pool}), 1)[0].tolist(), strict=True))
    pool.sort(key=hashes.get)
    draw, base = random.Random(3), pool[:360]
    for _ in range(200):
        extra = iter(draw.sample(pool[3000:], 200))
        own = [list(base) for _ in range(4)]
        for pair, n in {(1, 3): 8, (0, 1): 7, (0, 3): 7, (1, 2): 7, (2, 3): 7, (0, 2): 7}.items():
            for word in [next(extra) for _ in range(n)]:
                own[pair[0]].append(word)
                own[pair[1]].append(word)
        texts = [" ".join(o + [next(extra) for _ in range(400 - len(o))]) for o in own]
        values, bounds = jaccard_join._sets(pa.table({"text": texts}), 1)
        points = jaccard_join._vectors(values, bounds)
        bound = jaccard_join.overlap_bound(points[:, None], points[None])
        if max(bound[1, 0], bound[1, 2]) > bound[1, 3] < max(bound[3, 0], bound[3, 2]):
            break
    else:
        pytest.fail("no such bucket drawn")
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string").cache()
    docs.count()  # a table of known size, for the number of partitions
    found = jaccard_join.link_components(spark, docs, shingle=1, percent=85).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 3, 4: 2}


@pytest.mark.parametrize("share", [1 << 22, 300])
def test_rows_grow_with_a_group_below_the_threshold(spark, monkeypatch, share):
    """Forty alike documents (0.77), two of which link: no row a pair leaves the trees, in one share or in many."""
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda docs, shingle: np.zeros(0, np.uint64))
    monkeypatch.setattr(jaccard_join, "SHARE_SHINGLES", share)
    base = " ".join(f"w{i}" for i in range(87))
    texts = [f"{base} " + " ".join(f"x{d}y{i}" for i in range(13)) for d in range(40)]
    texts[31] = f"{base} " + " ".join(f"x17y{i}" if i < 9 else f"z{i}" for i in range(13))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()
    docs.count()
    made, edges = [], jaccard_join._candidate_edges

    def counted(*args):
        found = jaccard_join.cut_lineage(edges(*args))
        made.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "_candidate_edges", counted)
    found = {r.doc_id: r.component_id for r in jaccard_join.link_components(spark, docs, shingle=1, percent=85).collect()}
    assert found == {d: 17 if d == 31 else d for d in range(40)}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made and 0 < made[0] <= 39 * partitions < 40 * 39 / 2


def test_pipeline_stages(spark, docs, rows, tmp_path):
    items = [(0, " ".join({r[0]: r[1] for r in rows}[86].split()[500:540]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in current.collect()]
        stage(spark, current, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        current = spark.read.parquet(f"{tmp_path}/{number}")
        after = current.collect()
        if name != "byte_bpe":
            assert current.columns == docs.columns
        if name == "language_id":
            assert bag(after) == bag(r for r in before if any(c.isalpha() for c in r[1] or ""))
        elif name == "ngram_jaccard_join":
            label = linked(before, 5, 80)
            assert bag(after) == bag(r for r in before if r[0] is None or label[r[0]] == r[0])
        elif name == "substring_dedup":
            kept = Counter((i, " ".join(k)) for i, w, k in cut(before) if k or not w)
            assert Counter((r.doc_id, " ".join(words(r.text))) for r in after) == kept
        elif name == "decontamination":
            hit = {i for i, *_ in leaks(before, items)}
            assert bag(after) == bag(r for r in before if r[0] not in hit)
    assert bag(corpus_pipeline.run(spark, str(tmp_path)).collect()) == bag(after)
    assert len(after) > 30
