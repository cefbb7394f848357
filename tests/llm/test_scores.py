"""Language model, toxicity, pages, decontamination, language ID and mixing on small tables."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from msgrisk.llm import decontamination, language_id, language_model, mixing, page_text, toxicity
from msgrisk.llm.tokens import hash64, words


def test_words_and_hash():
    found = words(pa.array(["  The a\tb ", None, "", "x\x0b\x1cy  The"]))
    got = [found.vocab[int(k)].as_py() for k in found.ids]
    assert got == [b"the", b"a", b"b", b"x", b"\x1cy", b"the"] and found.starts.tolist() == [0, 3, 3, 3, 6]
    assert hash64(pa.array([b"ab", b"c", b"ab"]))[0] == hash64(pa.array([b"zz", b"ab"]))[1]
    assert len(set(hash64(pa.array([str(k) for k in range(20000)])).tolist())) == 20000


@pytest.fixture(scope="module")
def lm_rows():
    rng = random.Random(1)
    words_of = {"x": "alpha beta gamma delta".split(), "y": "uno dos tres cuatro".split()}
    rows = [(k, " ".join(rng.choice(words_of["xy"[k % 2]]) for _ in range(rng.randrange(0, 30)))) for k in range(300)]
    return rows + [(300, None), (301, ""), (302, "NEVER seen Alpha"), (None, "beta"), (303, "beta"), (303, "beta")]


def test_language_model(make_docs, lm_rows):
    train = [r for r in lm_rows if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10]
    model = language_model.fit(make_docs(train), "text")
    got = language_model.score(model, make_docs(lm_rows), "text", ("doc_id", "text")).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    counts = collections.Counter(w for _, t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(lm_rows)
    for r in got:
        w = tokens(r.text)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert abs(r.base_score - base) < 1e-8 and r.score < 0
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_is_a_distribution(make_docs, lm_rows):
    """Probabilities of all words, the end and one unknown word of each class add up to 1 after any history."""
    model = language_model.fit(make_docs(lm_rows), "text")
    vocab = pa.concat_arrays([model.head, pa.array([b"unseen%d" % k for k in range(400)], pa.binary())])
    coder = language_model._Coder(model.head.slice(0, language_model.OWN_BUCKETS))
    rank = coder.ranks(model.head)
    cls, place, _ = coder.describe(model.head, rank)
    prev, skip = np.full(len(cls), 3), np.full(len(cls), 5)
    p = language_model._run_log_probabilities(model.weights, model.class_bias, model.word_bias, cls, place, prev, skip)
    assert np.exp(p[place >= 0]).sum() <= 1 + 1e-4 and len(vocab)


def test_language_model_odd(odd, empty):
    model = language_model.fit(odd, "text")
    assert language_model.score(model, odd, "text", ("doc_id",)).count() == odd.count()
    assert language_model.score(model, empty, "text", ("doc_id",)).count() == 0
    nothing = language_model.fit(empty, "text")
    assert all(np.isfinite(r.base_score) for r in language_model.score(nothing, odd, "text", ("doc_id",)).collect())


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(7)
    plain = [f"p{k}" for k in range(200)]
    rows = []
    for k in range(400):
        text = [rng.choice(plain) for _ in range(40)]
        bad = k % 4 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(40)] = rng.choice(["idiot", "moron,"] if k % 8 else [f"grumpf{rng.randrange(90)}"])
        rows.append((k, " ".join(text), int(bad)))
    return rows


def test_toxicity(spark, make_docs, toxic_rows, odd, empty):
    frame = spark.createDataFrame(toxic_rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.where("doc_id % 3 <> 1"), "text", "toxic")
    got = toxicity.score(model, frame.where("doc_id % 3 = 1")).collect()
    assert np.mean([(r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in toxicity.score(model, odd).collect())
    assert toxicity.score(model, empty).count() == 0
    clauses = toxicity.matched_clauses(model, make_docs([(1, "fine words. you are an idiot today, then more")])).collect()
    assert [(c.first_word, c.last_word) for c in clauses] == [(2, 6)]
    toxicity.fit(frame.where("toxic = 5"), "text", "toxic")  # no labelled row


def test_grammar_weighs_clauses():
    model = toxicity.ToxicityModel({"idiot": 1.0}, np.zeros(3))

    def clause(text):
        return sum(h[3] for h in toxicity.clause_hits(model, pa.array([text])))

    plain, aimed = clause("what an idiot"), clause("you are an idiot")
    negated, reported = clause("she is not an idiot"), clause("the paper quoted an idiot")
    assert aimed > plain > reported > 0 and negated < plain
    threat = clause("i will kill you")
    assert threat == clause("you i will kill") == clause("i will kill you and your family") > 0
    assert 0 < clause("i will not kill you") < threat and 0 < clause("he said i will kill you") < threat
    # Nobody is aimed at: no target, one in another clause, or one too far behind.
    for text in ("i will kill", "i will kill, you see", "kill one two three four you", "nothing here"):
        assert clause(text) == 0
    assert clause("kill one two three you") == threat


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body><!-- c -->
<header><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></ul></nav><div class="cookie-notice">Accept</div>
<article><h1>Head&amp;line</h1><p>One <b>two</b>&nbsp;three,<br>four.<p>A<a title="x>y">B</a>.
<aside>side</aside><form>Mail<input></form></article><div id=comments><p>Great post!</p></div><footer>&copy; me</footer></body></html>"""


def test_page_text(spark):
    assert page_text.main_text(PAGE) == "Head&line\nOne two three, four.\nAB."
    plain = "<body><div class='menu'><a href=1>x</a></div><div><p>" + "Long text, of a kind. " * 20 + "</p><p>" + "More of it, too. " * 20 + "</p></div>"
    assert page_text.main_text(plain).count("\n") == 1
    rows = [(1, None, "u"), (2, "", "u"), (3, "no markup at all", None), (4, "<p>unclosed <b>bold", "u"), (5, "<<>><a", "u"), (5, "<<>><a", "u")]
    frame = spark.createDataFrame(rows, "page_id long, html string, url string")
    got = page_text.extract(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[1] == "" and page_text.extract(frame.where("page_id = 9")).count() == 0
    with pytest.raises(ValueError):
        page_text.extract(frame.withColumnRenamed("url", "text"))


def test_page_text_against_its_names():
    body = "".join(f"<p>Part {k} of it is a long text, with commas, and it goes on for a while; then it ends.</p>" for k in range(8))
    menu = "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>"
    card = "<article><h3>Teaser</h3><p>See more.</p></article>"
    for page in (
        f"<body>{menu}<div class=post>{body}</div>{card}</body>",
        f"<body class='right-sidebar has-ads'>{menu}{body}</body>",
        f"<body>{menu}<div class=legal-analysis>{body}</div><div class=cookie>Accept all.</div></body>",
        f"<body><form id=form>{menu}<article>{body}</article></form></body>",
        f"<body>{menu}<svg/><main>{body}</main><svg width='1' /></body>",
    ):
        text = page_text.main_text(page)
        assert text.count("Part ") == 8 and "Home" not in text and "Accept" not in text, page
    hidden = page_text.main_text(f"<body><article>{body}</article><div style='display:none'>{body * 9}</div></body>")
    assert hidden.count("Part ") == 8
    kept = page_text.main_text(f"<article>{body}<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, it is said.</p><object data=x><p>What the film shows, told.</p></object>"
                               f"<noscript><p>And, without scripts, this.</p></noscript></article>")
    assert "So x=1, it is said." in kept and "film shows" in kept and "without scripts" in kept


def test_decontamination(spark, make_docs, odd, empty):
    items = [(1, "Tom has 12 apples and gives 5 apples to Mary before he walks 3 km to the big market in town."),
             (2, "short one here"), (3, None), (4, "which of these four rivers is the longest in all of northern europe today")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs([
        (1, "x y z Bob has 30 apples and gives 7 apples to Jane before he walks 9 miles to the big market in town. end"),
        (2, "clean text about apples and markets " * 5), (3, items[0][1]), (4, "So " + items[3][1].upper()),
        # One name for both slots of the item: the slots do not map one to one.
        (5, "so Bob has 30 apples and gives 30 apples to Bob before Bob walks 30 km"), (6, None), (3, items[0][1]),
    ])
    got = decontamination.find_leaks(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (3, 1), (3, 1), (4, 4)]
    counted = {r.doc_id: r.n_leaks for r in decontamination.count_leaks(docs, bench).collect()}
    assert counted == {1: 1, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0}
    assert decontamination.find_leaks(odd, bench).count() == 0 and decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("item_id > 9")).count() == 0


def test_decontamination_of_changed_copies(spark, make_docs):
    rng = random.Random(12)
    long = [f"q{rng.randrange(10_000)}x" for _ in range(40)]
    question = "When does Tom with his 25 apples reach Anna and her 30 pears on his old red bicycle ?".split()
    german = "der alte Hund sieht das kleine Haus hinter dem grünen Wald und bellt die Katze an".split()
    items = [(1, " ".join(long)), (2, " ".join(question)), (3, " ".join(german))]
    longer = " ".join(w + " extra" * (k % 12 == 11) for k, w in enumerate(long))
    shorter = " ".join(w for k, w in enumerate(long) if k % 10 != 9)
    value = {"Tom": "Mary Ann", "25": "twenty five", "Anna": "Jo Lee Kim", "30": "seventy"}
    far = " ".join(long[:12] + [f"z{k}" for k in range(200)] + long[12:20])
    docs = make_docs([
        (1, f"lead {longer} tail"), (2, f"lead {shorter} tail"), (3, " ".join(value.get(w, w) for w in question)),
        (4, " ".join(german).lower()), (5, " ".join(german).upper()), (6, "so " + " ".join(long[12:20] + ["and"] + long[:12])), (7, far),
    ])
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sorted(got) == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3)]
    assert (got[1, 1].first_word, got[1, 1].n_words, got[1, 1].n_covered, got[1, 1].longest_run) == (1, 40, 36, 12)
    assert (got[2, 1].n_covered, got[2, 1].longest_run) == (36, 9) and got[3, 2].n_covered == got[3, 2].n_words


def test_decontamination_in_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 30)
    rng = random.Random(3)
    items = [(k, " ".join(f"q{rng.randrange(500)}" for _ in range(20))) for k in range(12)]
    docs = make_docs([(k, "lead in " + t) for k, t in items] + [(99, "nothing to see")])
    got = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(k, k) for k in range(12)]


@pytest.fixture(scope="module")
def tagger(make_docs):
    rng = random.Random(8)
    ends = {"aa": ["ung", "keit", "lich"], "bb": ["tion", "eux", "elle"], "cc": ["mente", "ado", "rra"]}
    rows = [(k, " ".join(f"{rng.choice('bdfgklm')}{rng.choice('aeiou')}{rng.choice(ends[lang])}" for _ in range(rng.randrange(3, 40))), lang)
            for k in range(240) for lang in [["aa", "bb", "cc"][k % 3]]]
    return language_id.fit(make_docs(rows), "text", "lang"), rows


def test_language_id(make_docs, tagger, odd, empty):
    model, rows = tagger
    got = language_id.identify(model, make_docs(rows)).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.99 and all(0 <= r.score <= 1 for r in got)
    assert language_id.identify(model, empty).count() == 0
    strange = {(r.doc_id, r.n_chars): (r.lang_pred, r.score) for r in language_id.identify(model, odd).collect()}
    assert strange[1, 0] == strange[2, 0] == strange[4, 2] == ("und", 0.0)
    none = language_id.fit(make_docs(rows[:0]), "text", "lang")
    assert {r.lang_pred for r in language_id.identify(none, odd).collect()} == {"und"}
    mixed = language_id.word_languages(model, make_docs([(1, "bakeit dalich gaung fakeit lalich ! batelle moeux kation laelle detion")])).orderBy("position").collect()
    assert [r.language for r in mixed][:4] == ["aa"] * 4 and [r.language for r in mixed][7:] == ["bb"] * 4 and mixed[5].language == "und"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    score, edges = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    starts = np.array([0, 4, 4, 5])
    pairs = np.zeros((3, 3))
    got = language_id.forward_backward(score, starts, edges, pairs)
    want, joint = np.zeros((5, 3)), np.zeros((3, 3))
    for a, b in ((0, 4), (4, 5)):
        paths = list(np.ndindex(*[3] * (b - a)))
        w = np.array([np.exp(sum(score[a + t, y] for t, y in enumerate(p)) + sum(edges[x, y] for x, y in zip(p, p[1:]))) for p in paths])
        for p, x in zip(paths, w / w.sum()):
            for t, y in enumerate(p):
                want[a + t, y] += x
            for y, z in zip(p, p[1:]):
                joint[y, z] += x
    assert np.allclose(got, want) and np.allclose(pairs, joint)


def brute_targets(words_of):
    order = sorted((s for s in words_of if s is not None)) + ([None] if None in words_of else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    capped, total = set(), sum(words_of.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(3 * words_of[s] for s in capped)
        share = sum(weight[s] for s in rest)
        over = {s for s in rest if left * weight[s] / share > 3 * words_of[s]}
        if not over:
            return {s: 3.0 * words_of[s] if s in capped else left * weight[s] / share for s in order}
        capped |= over


@pytest.mark.parametrize("block", [4096, 32])
def test_mixing(make_docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    rng = random.Random(6)
    sources = ["a", "b", "ß", None, "z", "tiny"]
    rows = [(k, " ".join(["w"] * rng.randrange(0, 40)), "en", rng.choice(sources[:5])) for k in range(700)]
    rows += [(900, "one two", "en", "tiny"), (901, None, "en", "empty"), (5, "w w", "en", "a"), (5, "w w", "en", "a"), (None, "w", "en", "a")]
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows)
    total = collections.Counter()
    for _, t, _, s in rows:
        total[s] += len((t or "").split())
    want = brute_targets(total)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == total[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 6 for s in want if s not in ("tiny", "empty"))
    again = mixing.mix(make_docs(rows[::-1]).repartition(3)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixing_odd(odd, empty):
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(empty).count() == 0


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    p, size = rng.random(500), rng.integers(0, 300, 500).astype(float)
    out = np.array(mixing._flight(p.tolist(), size.tolist(), rng))
    assert ((out > 0) & (out < 1)).sum() <= 2 and abs(out.sum() - p.sum()) < 1e-6 and abs(out @ size - p @ size) < 1e-4
