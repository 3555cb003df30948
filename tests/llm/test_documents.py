"""Operators that look at each document by itself."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmscope.llm import language, lattice, licenses, lm, quality, queries, toxicity
from tests.llm import brute
from tests.llm.conftest import DATA, TEXT


def rows_by_id(df):
    return {row.doc_id: row for row in df.collect()}


def test_licenses_find_every_phrase(spark, texts):
    found = rows_by_id(queries.QUERIES["op1_license_scan"](spark, DATA))
    assert set(found) == {i for i, _ in texts}
    for doc_id, text in texts:
        places = {p: licenses.phrase_places(text, p) for p in licenses.PHRASES}
        every = [k for ks in places.values() for k in ks]
        row = found[doc_id]
        assert (row.n_base, row.first_word, row.last_word) == (len(every), min(every, default=None), max(every, default=None))
        base = sorted(licenses.PHRASES[p] for p, ks in places.items() if ks)
        assert row.base_labels == ",".join(base)
        assert set(base) <= set(row.labels.split(","))  or not base
        assert 0 <= row.score <= 1


def test_matching_statistics_against_all_substrings():
    sequences = [[1, 2, 3, 1, 2, 4], [2, 3, 3, 1], [4, 4, 1, 2, 3]]
    inside = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a, len(s) + 1)}
    automaton = licenses.Automaton(sequences)
    luck = np.random.default_rng(0)
    for _ in range(200):
        text = luck.integers(1, 6, 15).tolist()
        for k, (state, length) in enumerate(automaton.walk(text)):
            best = max(n for n in range(k + 2) if tuple(text[k + 1 - n : k + 1]) in inside)
            assert length == best
            holders = {j for j, s in enumerate(sequences) if best and any(s[a : a + best] == text[k + 1 - best : k + 1] for a in range(len(s)))}
            assert not best or set(automaton.places[state]) == holders


def test_license_templates_are_covered_in_order(spark):
    body = dict(licenses.TEMPLATES)["isc"]
    half = " ".join(body.split()[::-1])
    rows = [(1, f"Header. {body.upper()}! tail"), (2, half), (3, body.replace("without fee", "with no fee at all"))]
    found = rows_by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found[1].labels == "isc" and found[1].score == 1.0 and found[1].spans[0].start == 1
    assert found[2].labels == "" and found[3].labels == "isc" and found[3].score < 1


def _label(text):
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    _, chains = scanner.scan(licenses.tokens(text.encode()))
    return {scanner.template_labels[t] for t, *_, share in chains if share >= licenses.MIN_SHARE}


@pytest.mark.parametrize("n", [0, 7, 9, 25, 60])
def test_licenses_with_foreign_words_inside(n):
    body = max((text for label, text in licenses.TEMPLATES if label == "mit"), key=len).split()
    foreign = [f"foreign{k}" for k in range(n)]
    half = len(body) // 2
    assert "mit" in _label(" ".join(body[:half] + foreign + body[half:]))
    third = len(body) // 3
    assert "mit" in _label(" ".join(body[:third] + foreign[: n // 2] + body[third : 2 * third] + foreign[: n // 2] + body[2 * third :]))


def test_license_versions_need_their_word():
    assert _label("licensed under the gnu general public license") == set()
    assert _label("licensed under the GNU General Public License, version 3") == {"gpl-3.0"}
    assert _label("licensed under the gnu general public license version 2") == {"gpl-2.0"}
    assert _label("it is licensed under the apache license somewhere") == set()
    assert _label("licensed under the apache license version 2 0") == {"apache-2.0"}


def test_chains_against_all_subsets():
    """Templates with repeated parts, few words, and every choice of matches and places."""
    luck = np.random.default_rng(1)
    for _ in range(60):
        template = " ".join(luck.choice(list("abcd"), 14))
        scanner = licenses.Scanner({}, (("x", template),))
        text = [w.encode() for w in luck.choice(list("abcde"), 30)]
        matches = []
        scanner.chain = lambda t, found, matches=matches: matches.extend(found)
        scanner.scan(text)
        best = 0.0
        words = template.split()
        for match in matches:
            own = [w.decode() for w in text[match.begin : match.end]]
            assert list(match.places) == [k + len(own) for k in range(len(words) - len(own) + 1) if words[k : k + len(own)] == own]

        def follow(end, place, worth, rest):
            nonlocal best
            best = max(best, worth)
            for k, match in enumerate(rest):
                n = match.end - match.begin
                for own in match.places:
                    gained = min(match.end - max(match.begin, end), own - max(own - n, place))
                    if gained > 0 and match.end > end:
                        follow(match.end, own, worth + gained - licenses.GAP_COST * max(0, match.begin - end), rest[k + 1 :])

        rest = sorted(matches, key=lambda m: (m.end, m.begin))[:9]
        for k, match in enumerate(rest):
            for own in match.places:
                follow(match.end, own, match.end - match.begin, rest[k + 1 :])
        found = licenses.Scanner.chain(scanner, 0, rest)
        assert (found[2] if found else 0.0) == pytest.approx(min(1.0, best / len(words)))


def test_quality_counts(spark, texts):
    found = rows_by_id(queries.QUERIES["op2_quality_rules"](spark, DATA))
    for doc_id, text in texts:
        row = found[doc_id]
        expected = brute.quality(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        failed = expected[0] < 10 or 100 * expected[4] > 20 * expected[0]
        assert row.base_failed == failed and not (failed and row.kept)


def test_quality_counts_of_repeats():
    import pyarrow as pa

    from firmscope.llm.words import stretches, words

    made = ["a b c d e f a b c d e g", "a a a a a a", "l one\nl one\n\n\nl two\nl one", "é # é # é", "", "a b c d e", "a b c d e"]
    for _, _, data, offsets in stretches(pa.array(made)):
        got = quality.counts(data, offsets, words(data, offsets))
    assert list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True)) == [
        brute.quality(t) for t in made
    ]


def test_quality_learns(spark, documents, labels):
    """Good rows of the labelled ones are kept, by a model that has seen them or not."""
    judged = quality.judge(documents, quality.fit(documents, labels)).join(labels, "doc_id")
    good = judged.filter("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.9


def test_quality_of_rows_not_learned_from(spark):
    """Fitted on labels of other rows only: good rows stay, bad ones go."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    judged = quality.judge(docs, quality.fit(docs, labels.filter(~out))).join(labels.filter(out), "doc_id")
    kept = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.9 and kept[0] < 0.1


def test_long_labelled_rows_are_learned_from(spark):
    """Where only long rows tell good from bad."""
    luck = np.random.default_rng(0)
    good, bad = ([f"{name}{k}" for k in range(40)] for name in ("calm", "spam"))
    rows = [(k, " ".join(luck.choice(bad if k % 2 else good, 6_000)), 1 - k % 2) for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    fresh = [(1, " ".join(good)), (2, " ".join(bad))]
    found = rows_by_id(quality.judge(spark.createDataFrame(fresh, "doc_id long, text string"), model))
    assert found[1].kept and not found[2].kept


def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.QUERIES["op6_toxicity"](spark, sf)
    judged = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    toxic, clean = (judged.filter(f"toxic = {y}").agg(F.avg("predicted")).first()[0] for y in (1, 0))
    assert toxic > 0.8 and clean < 0.02
    assert found.filter("score < 0 or score > 1 or predicted != int(score >= 0.3)").count() == 0


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_lexicon_accepts_what_is_one_edit_away():
    terms = ["idiot", "idiots", "moron", "scum", "worthless"]
    lexicon = toxicity.Lexicon(terms, ["lowei"])
    luck = np.random.default_rng(3)
    for _ in range(3000):
        word = list(luck.choice(terms))
        for _ in range(luck.integers(0, 3)):
            at, how = luck.integers(0, len(word)), luck.integers(0, 3)
            word[at : at + (how != 2)] = [] if how == 0 and len(word) > 1 else [luck.choice(list("idotwx"))]
        word = "".join(word)
        near = any(len(t) >= 5 and word[0] == t[0] and distance(word, t) <= 1 for t in terms)
        expected = [0, 1, 0, 0] if word in terms else [0, 0, 1, 0] if near else [0, 0, 0, 0]
        assert toxicity.hits(lexicon, [word])[0][:4].tolist()[1:] == expected[1:]
    assert toxicity.hits(lexicon, ["Loweiaus and LOWEI"])[0][3] == 2


def test_stems_and_words_split_by_signs_take_one_edit():
    lexicon = toxicity.Lexicon(["worthless"], ["idiot", "zokkelm"])
    luck = np.random.default_rng(4)

    def near(word, stem):
        inside = any(distance(word[:n], stem) <= 1 and word[n - 1] == stem[-1] for n in range(4, len(word) + 1))
        return word[0] == stem[0] and (distance(word, stem) <= 1 or inside)

    for _ in range(3000):
        stem = str(luck.choice(["idiot", "zokkelm"]))
        word = list(stem + "".join(luck.choice(list("enst"), luck.integers(0, 3))))
        for _ in range(luck.integers(0, 3)):
            at, how = luck.integers(0, len(word)), luck.integers(0, 3)
            word[at : at + (how != 2)] = [] if how == 0 else [luck.choice(list("idotzkx"))]
        word = "".join(word)
        expected = [0, 0, 1] if word.startswith(stem) else [0, int(near(word, stem)), 0]
        assert toxicity.hits(lexicon, [word])[0][1:4].tolist() == expected, word
    for word in ("id1ot", "id*ot", "w0rthless", "worth-less", "zok3elmen"):
        assert toxicity.hits(lexicon, [f"an {word}, so"])[0][1:4].tolist() == [0, 1, 0], word
    assert toxicity.hits(lexicon, ["id ot", "id\not", "id1", "w0rthl3ss", "it's"])[:, 1:4].sum() == 0
    assert toxicity.hits(lexicon, ["x-idiot, idiot's"])[0][1:4].tolist() == [0, 0, 2]
    assert toxicity.hits(lexicon, ["a " * (toxicity.PIECE // 2 - 1) + "id1ot"])[0][2] == 1


def test_toxic_terms_that_stand_beside_others_are_mined(spark):
    """Every telling term, whatever the number of toxic rows; a beginning only where its words do not tell all."""
    rows, labels = [], []
    for k in range(3000):
        toxic = k % 2
        words = ["plain", f"filler{k % 7}"]
        if toxic:
            words += ["gralk"] + ["vrump"] * (k % 4 == 1) + ["zokkel"] * (k < 80) + [f"brelno{chr(97 + k // 20 % 25) * 3}"] * (k % 20 == 1)
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    own = ["gralk", "vrump", "zokkel", "brelnozzz", "plain", "filler"]
    found = rows_by_id(toxicity.score_toxicity(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string"), model))
    hits = {word: found[k].n_terms + found[k].n_stems for k, word in enumerate(own)}
    assert hits == {"gralk": 1, "vrump": 1, "zokkel": 1, "brelnozzz": 1, "plain": 0, "filler": 0}


def test_quotation_scores_below_abuse():
    lexicon = toxicity.Lexicon(["idiot"], [])
    quoted, abuse = 'the term "idiot" is an insult', "you are an idiot"
    scores = toxicity.features(toxicity.hits(lexicon, [quoted, abuse])) @ toxicity.PRIOR
    assert scores[0] < 0 < scores[1]


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op8_language_id"](spark, sf)
    judged = found.join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").filter("held_out and lang_pred != 'und'")
    assert judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_language_against_one_word_at_a_time(spark, documents, texts):
    """Posteriors from each word's own marginals, which are checked against all segmentations elsewhere."""
    import pickle

    model = language.fit(documents, size=30)
    langs, path, scores = pickle.loads(model)
    found = rows_by_id(language.predict(documents, model))
    known = {}
    for doc_id, text in texts[:60]:
        total = np.zeros(len(langs))
        for word in language.words_of(text):
            if word not in known:
                known[word] = lattice.log_marginals(lattice.pieces(path), [word.encode()], scores)[0]
            total += known[word]
        row = found[doc_id]
        if not language.words_of(text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        odds = np.exp(total - total.max())
        assert row.lang_pred == langs[int(np.argmax(total))]
        assert row.score == pytest.approx(odds.max() / odds.sum(), rel=1e-3)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.QUERIES["op8_language_id"](spark, sf).filter("held_out and lang_pred != 'und'").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95


def test_language_without_ids(spark, documents):
    """Rows without an id, or with one id in bulk, are sampled one by one."""
    for name in (F.lit(None).cast("long"), F.lit(9)):
        docs = documents.withColumn("doc_id", name)
        model = language.fit(docs, size=20)
        found = language.predict(docs.select("doc_id", "text"), model)
        langs = [r.lang for r in docs.select("lang").collect()]
        right = [r.lang_pred == lang for r, lang in zip(found.collect(), langs, strict=True) if r.lang_pred != "und"]
        assert sum(right) > 0.95 * len(right)


def test_numbers_are_no_letters(spark, documents):
    rows = [(1, "½ ² Ⅷ 12 ①_"), (2, "x²y ½"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_by_id(language.predict(docs, language.fit(documents)))
    assert [found[k].lang_pred == "und" for k in (1, 2, 3, 4)] == [True, False, True, True]
    assert language.words_of("x²y ½ ÉTÉ 漢一") == ["x", "y", "été", "漢一"]


def test_marginals_against_all_segmentations():
    vocabulary = lattice.pieces(language.vocabulary_path())
    luck = np.random.default_rng(1)
    scores = np.log(luck.dirichlet(np.ones(vocabulary.size), 2).T + 1e-12)
    made = [b"", b"the", "Übergröße".encode(), b"x" * 60, "漢".encode()]
    number = {piece: k for k, piece in vocabulary.texts.items()}

    def every(word, model):
        if not word:
            return 1.0
        return sum(np.exp(scores[number[word[:k]], model]) * every(word[k:], model) for k in range(1, len(word) + 1) if word[:k] in number)

    got = lattice.log_marginals(vocabulary, made, scores)
    for k in (0, 1, 4):
        for model in (0, 1):
            assert got[k, model] == pytest.approx(np.log(every(b" " + made[k], model)))
    assert np.isfinite(got).all()


def test_marginals_and_pieces_of_long_words(monkeypatch):
    vocabulary = lattice.pieces(language.vocabulary_path())
    luck = np.random.default_rng(2)
    scores = np.log(luck.dirichlet(np.ones(vocabulary.size), 2).T + 1e-12)
    made = [TEXT.replace(" ", "").encode()[:n] for n in (47, 48, 49, 95, 96, 97)]
    made += [("漢字かな交じり文" * 8).encode(), "donaudampfschifffahrtsgesellschaftskapitän".encode() * 4, b"x" * 200, b"a", b""]
    number = {piece: k for k, piece in vocabulary.texts.items()}
    expected = np.zeros((len(made), 2))
    for k, word in enumerate(made):
        word, forward = b" " + word, [np.zeros(2)]
        for b in range(1, len(word) + 1):
            forward.append(np.logaddexp.reduce([forward[a] + scores[number[word[a:b]]] for a in range(b) if word[a:b] in number]))
        expected[k] = forward[-1]
    assert lattice.log_marginals(vocabulary, made, scores) == pytest.approx(expected)
    monkeypatch.setattr(lattice, "SIDE_BY_SIDE", 40)
    for size in (7, 50, 1 << 16):
        monkeypatch.setattr(lattice, "STRETCH", size)
        assert lattice.log_marginals(vocabulary, made, scores) == pytest.approx(expected)
    who, what = lattice.longest_pieces(vocabulary, made)
    for k, word in enumerate(made):
        word, greedy = b" " + word, []
        while word:
            n = max(n for n in range(1, len(word) + 1) if word[:n] in number)
            greedy.append(number[word[:n]])
            word = word[n:]
        assert what[who == k].tolist() == greedy


def test_lm(spark, texts):
    found = rows_by_id(queries.QUERIES["op4_lm_scoring"](spark, DATA))
    for doc_id, (n, known, train, score) in brute.word_model(texts).items():
        row = found[doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, train)
        assert row.base_score == pytest.approx(score, rel=1e-9)
        assert row.held_out == (brute.crc(doc_id) % 7 == 2) and row.score < 0


def test_lm_blocks_change_nothing(documents):
    one, many = lm.score_texts(documents), lm.score_texts(documents, block_bytes=20_000)
    many = {r.doc_id: r for r in many.collect()}
    for row in one.collect():
        assert many[row.doc_id].score == pytest.approx(row.score) and many[row.doc_id].n_known == row.n_known


def test_odd_documents(odd, labels):
    n = odd.count()
    scanned = licenses.scan_licenses(odd)
    judged = quality.judge(odd, quality.fit(odd, labels))
    toxic = toxicity.score_toxicity(odd, toxicity.fit(odd, labels))
    spoken = language.predict(odd, language.fit(odd))
    scored = lm.score_texts(odd)
    for df in (scanned, judged, toxic, spoken, scored):
        found = df.collect()
        assert len(found) == n and sum(r.doc_id is None for r in found) == 1
    assert all(r.lang_pred == "und" and r.score == 0 for r in spoken.collect() if r.doc_id in (3, 4, 5))
    assert {(r.n_words, r.base_failed, r.kept) for r in judged.collect() if r.doc_id in (3, 4, 5)} == {(0, True, False)}
    assert {r.n_tokens for r in scored.collect() if r.doc_id in (3, 4, 5)} == {1}
    assert {r.n_words for r in scanned.collect() if r.doc_id == 6} == {60_000}


def test_no_documents(none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (
        licenses.scan_licenses(none),
        quality.judge(none, quality.fit(none, labels)),
        toxicity.score_toxicity(none, toxicity.fit(none, labels)),
        language.predict(none, language.fit(none)),
        lm.score_texts(none),
    ):
        assert df.collect() == []


def test_words_of_odd_bytes(spark):
    rows = [(1, f"{TEXT}\x0b\x0c\r\n\tgnu general gnu  general-public_license MIT\nlicense")]
    row = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert row.base_labels == "gpl,mit" and row.n_base == 2


def test_new_words_cost_no_more_than_the_tokenizer():
    """Ids are those of the whole tokenizer, for odd words and beyond what is remembered; plain new words take no more of the CPU."""
    import time

    from tokenizers import Tokenizer

    from firmscope.llm import packing

    chunks = packing.Chunks(packing.vocabulary_path())
    whole = Tokenizer.from_file(chunks.path)
    odd = "\u0130stanbul DON'T they'LL <|endoftext|> a<|b \u00adsoft na\u00efve \u00c0\u00c9\u00df. \u6f22\u5b57 \u00bd 1234 a1b2 ...!? e\u0301. 's _a_ \u017f x\x00y".split()
    signs = np.array(list("abcdefghijklmnopqrstuvwxyz\u00e4\u00e9"))
    rng = np.random.default_rng(1)
    rounds = [odd + ["".join(signs[rng.integers(0, 28, 9)]) for _ in range(30_000)] for _ in range(5)]
    ours, theirs = [], []
    for words in rounds:
        began = time.process_time()
        sizes, ids = chunks._learn(words)
        ours.append(time.process_time() - began)
        began = time.process_time()
        want = [whole.encode(" ".join(words[k : k + 256]), add_special_tokens=False).ids for k in range(0, len(words), 256)]
        theirs.append(time.process_time() - began)
        assert ids.tolist() == [i for part in want for i in part]
        assert sizes[: len(odd)].tolist() == [len(whole.encode(w, add_special_tokens=False).ids) for w in odd]
    assert min(ours) < 1.2 * min(theirs), (ours, theirs)
