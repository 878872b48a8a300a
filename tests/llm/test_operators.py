"""Each operator on small tables with nulls, empty and long texts, ties, repeats, no rows and clashing columns."""

import base64
import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import corpus_pipeline
from starload.llm import bpe, curriculum, ego_join, langid, line_templates, ngram_join, page_text, stages, topk, toxicity
from starload.llm import training_order as order
from starload.llm.components import components

RANKS = P.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, n int, size long, label int"
LONG = "lorem ipsum dolor " * 8000
TEXTS = [None, "", " \t\n", "one", "One two", "a b c d e f g h", "A b\tc d e f g H", "a b c d e f g x", "é,a é!b ÷ 12½ \U0001f600 漢字",
         "it's  I'LL \n\n x  y \n", "z" * 9000, LONG, LONG + "x", "don't  \t b", "a \u0085 b   c", "\x00 a\x00"]


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "de", None][k % 3], ["s1", "s2", None][k % 3], 0, 7, 7, 7, 7) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# ---- op1 -------------------------------------------------------------------------------------------

def test_topk_matches_brute_force(llm):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)], 1) for i in range(300)]
    rows += [(300, None, 1), (301, [None] * 8, 1), (302, [float("nan")] * 8, 1), (303, [], 1), (None, [1.0] * 8, 1),
             (304, rows[0][1], 1), (305, rows[0][1], 1), (306, [1.0, 2.0], 1), (320, [2.0, 1.0], 1)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    vectors = topk.integer_vectors(table)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.topk(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()}
    sound = {r[0]: [math.floor(64 * x) for x in r[1]] for r in rows
             if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])}
    want = {}
    for q, v in sound.items():
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound.items() if i != q and len(w) == len(v))
            want.update({(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[:20])})
    assert got == want
    with pytest.raises(PySparkException, match="beyond"):
        topk.integer_vectors(llm.createDataFrame([(0, [1e300], 1)], table.schema)).collect()
    large = topk.integer_vectors(llm.createDataFrame([(0, [1e12], 1)], table.schema))
    with pytest.raises(ValueError):
        topk.topk(large, large, 1)
    empty = topk.integer_vectors(table.limit(0))
    assert topk.topk(empty, empty, 3).count() == 0


def test_topk_over_many_chunks(llm, monkeypatch):
    """Several rounds over many small chunks, with ties across chunks: equal to brute force."""
    monkeypatch.setattr(topk, "CHUNK", 25)
    rng = np.random.default_rng(11)
    centres = rng.integers(-9, 10, (12, 6))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.integers(-2, 3, 6)]) for i in range(900)]
    vectors = llm.createDataFrame(rows, "vec_id long, vec array<double>")
    asked = vectors.where("vec_id % 30 = 0")
    got = {}
    for r in topk.topk(vectors, asked, 7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, v in rows[::30]:
        best = sorted((-int(np.dot(v, w)), i) for i, w in rows if i != q)[:7]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


# ---- op2 -------------------------------------------------------------------------------------------

def groups_by_force(texts, width, percent):
    low = {i: i + 32 for i in range(65, 91)}
    sets = []
    for t in texts:
        w = words((t or "").translate(low))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return [(len(s), r) for s, r in zip(sets, root)]


def test_jaccard_groups_match_brute_force(llm):
    rng = np.random.default_rng(2)
    texts = list(TEXTS)
    for _ in range(6):  # families of copies with a few replaced words, chains included
        base = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(20, 200)))]
        for _ in range(12):
            texts.append(" ".join(base))
            base = list(base)
            base[int(rng.integers(len(base)))] = f"v{rng.integers(10 ** 6)}"
    for width, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(documents(llm, texts), width, percent).collect()}
        assert [got[i] for i in range(len(texts))] == groups_by_force(texts, width, percent)


def test_jaccard_groups_edges(llm):
    docs = documents(llm, ["a b c d e f", "a b c d e f", None, "x"], ids=[5, 5, 6, None])
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(docs).collect()), key=str)
    assert rows == sorted([(5, 2, 5), (5, 2, 5), (6, 0, 6), (None, 1, None)], key=str)
    assert ngram_join.jaccard_groups(documents(llm, [])).count() == 0


def test_components_of_a_long_chain(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.comp for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- op3, op4 --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(llm, library):
    got = {r.doc_id: r for r in bpe.encode_documents(documents(llm, TEXTS), RANKS, P.PATTERN, keep_ids=True).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode_ordinary(t or "")
        assert got[i].token_ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(documents(llm, []), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 64, 1000])
def test_permutation_is_a_bijection(total):
    assert sorted(order.permute(np.arange(total), total, key=9).tolist()) == list(range(total))
    assert total < 64 or order.permute(np.arange(total), total, 9).tolist() != order.permute(np.arange(total), total, 10).tolist()


def test_shards_round_trip_and_resume(llm, library, tmp_path):
    docs = documents(llm, TEXTS + ["gone"], ids=[*range(len(TEXTS)), None]).repartition(3, "doc_id")
    slotted, total = order.assign_slots(docs, order.bpe_cutter(RANKS, P.PATTERN, 16), key=3)
    path = str(tmp_path / "shards")
    order.write_shards(slotted, total, path, token_bytes=32, shard_records=50)
    rows = order.read_shards(llm, path, 32, 50).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(total)) and all(r.shard == r.slot // 50 for r in rows)
    for i, t in enumerate(TEXTS):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.seq_no)
        assert [x for r in own for x in np.frombuffer(r.tokens, "<u2").tolist()] == library.encode_ordinary(t or "")
    gone = [r for r in rows if r.doc_id is None]  # a document without an id is in the shards as well
    assert [x for r in gone for x in np.frombuffer(r.tokens, "<u2").tolist()] == library.encode_ordinary("gone")
    later = order.read_shards(llm, path, 32, 50, from_slot=77).orderBy("slot").collect()
    assert later == rows[77:]


# ---- op5 -------------------------------------------------------------------------------------------

def test_recurring_lines_stay_in_the_first_document_only(llm):
    common = "posted by user{} on a fine day in spring 20{}"
    texts = [f"{common.format(i, i)}\nshort line\nbody {'abcdefgh'[i % 8] * 3} of number {'klmnopqr'[i % 8] * 4} alone" for i in range(8)]
    texts += [None, "", "x\n\ny", common.format(1, 2) + "\n" + common.format(3, 4)]
    got = {r.doc_id: r for r in line_templates.drop_recurring(documents(llm, texts)).collect()}
    assert got[0].text == texts[0] and got[0].n_dropped == 0
    for i in range(1, 8):
        assert got[i].text == texts[i].split("\n", 1)[1] and (got[i].n_lines, got[i].n_dropped) == (3, 1)
    assert got[8].text is None and got[8].n_lines == 0
    assert [got[i].text for i in (9, 10, 11)] == ["", "x\n\ny", ""]
    assert line_templates.drop_recurring(documents(llm, [])).count() == 0


def test_rows_of_one_id_and_without_an_id(llm):
    """Rows are documents by id and text: a clean line at the place of another row's recurring line stays; null ids are deduplicated."""
    common = "this notice stands on every page of the site"
    texts = [f"{common}\nbody {c * 4} of one alone" for c in "abcd"] + ["a clean first line of its own\n" + common, f"{common}\nbody xxxx of one alone"]
    docs = documents(llm, texts, ids=[1, 2, 3, 4, 4, None])
    got = Counter((r.doc_id, r.text) for r in line_templates.drop_recurring(docs).collect())
    assert got == Counter([(1, texts[0])] + [(i, t.split("\n")[1]) for i, t in zip((2, 3, 4), texts[1:4])]
                          + [(4, "a clean first line of its own"), (None, "body xxxx of one alone")])
    none = documents(llm, [t.replace("body", "own") for t in texts], ids=[None] * 6)
    assert sum(common in r.text for r in line_templates.drop_recurring(none).collect()) == 1


def test_templates_of_a_leaf():
    t = line_templates.Templates(0.6)
    assert [t.add(x) for x in ("a b c d e", "a b c x y", "a b q r s", "a b c d z")] == [0, 0, 1, 0]


def test_templates_by_pieces_equal_all_compared():
    rng = np.random.default_rng(3)
    for size, similar in ((4, 0.8), (5, 0.8), (10, 0.8), (12, 0.6), (7, 0.0)):
        lines = ["a b c " + " ".join(rng.choice(list("defgh"), size - 3)) for _ in range(1500)]
        got, rows, want = line_templates.Templates(similar), [], []
        for line in lines:
            words_ = line.split(" ")
            k = next((k for k, r in enumerate(rows) if sum(x == y for x, y in zip(r, words_)) >= similar * size), None)
            if k is None:
                rows.append(list(words_))
            else:
                rows[k] = [x if x == y else "<*>" for x, y in zip(rows[k], words_)]
            want.append(len(rows) - 1 if k is None else k)
        assert [got.add(x) for x in lines] == want


def test_a_template_recurs_in_a_large_leaf_too(llm):
    """A template with a field in tokens 4 to 6 is found among thousands of other lines of its leaf."""
    rng = np.random.default_rng(4)
    other = ["we saw the " + " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(7)) for _ in range(9000)]
    lines = [f"we saw the {c * 5} go by the old stone mill" for c in "klmnop"]
    docs = documents(llm, ["\n".join(other)] + [f"{line}\nown {k}" for k, line in enumerate(lines)])
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}


def test_short_and_long_lines_recur_by_themselves(llm):
    """A short line recurs by more documents than a template, an exact line of many words by two."""
    long = " ".join(f"{c}{d}" for c in "abcde" for d in "vwxyz")
    texts = [f"own {c * 4}\nAll rights reserved.\n17\n\n" + ("Les.\n" if k < line_templates.SHORT_DOCS - 1 else "") + (long if k in (4, 9) else "")
             for k, c in enumerate("abcdefghijklmnop")]
    texts += [long.replace("av", "av1") + " " + "9 " * 30, long.replace("av", "other"), "9 " * 30, "8 " * 30]
    got = [r.text for r in line_templates.drop_recurring(documents(llm, texts)).orderBy("doc_id").collect()]
    want = [texts[0]] + [t.replace("All rights reserved.\n", "") for t in texts[1:16]] + texts[16:]
    want[9] = want[9].replace("\n" + long, "")
    assert got == want


# ---- op6 -------------------------------------------------------------------------------------------

def test_languages_and_bundles(llm):
    en, de = "the quick brown fox jumps over the lazy dog", "der schnelle braune Fuchs springt über den faulen Hund"
    docs = documents(llm, [en, de, None] * 10)
    langs, prototypes = langid.fit(docs)
    assert langs == ["de", "en"]
    got = [(r.lang_pred, round(r.score, 6)) for r in langid.predict(documents(llm, [en, de.upper(), "12 !", None, "", LONG]),
                                                                   langs, prototypes).orderBy("doc_id").collect()]
    assert got[0] == ("en", 1.0) and got[1][0] == "de" and got[2:5] == [("und", 0.0)] * 3 and got[5][0] in langs
    # counting first gives the bundle of the bound vectors
    code, _, _ = langid.trigrams([en])
    bundle = langid.bind(code, langid.DIMENSIONS).sum(axis=0)
    cos, _ = langid.cosines([en], prototypes)
    assert np.allclose(bundle @ prototypes.T / np.linalg.norm(bundle), cos[0], atol=1e-5)
    langs, prototypes = langid.fit(documents(llm, []))
    assert [r.lang_pred for r in langid.predict(docs.limit(2), langs, prototypes).collect()] == ["und"] * 2


def test_gate_turns_away_what_is_no_learned_language(llm):
    rng = np.random.default_rng(9)
    stems = {"en": "the of and to in that is was for it with as his on be at by".split(),
             "de": "der die und das von zu mit sich auf für ist im dem nicht ein eine als".split(),
             "fi": "ja on ei että hän oli joka mutta myös sekä kun niin kuin ovat tämä mukaan".split()}

    def text(lang):
        return " ".join(rng.choice(stems[lang]) + str(rng.choice(["", "", "ing" if lang == "en" else "en"])) for _ in range(int(rng.integers(4, 60))))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["en", "de"] * 400)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, prototypes = langid.fit(docs.where("doc_id < 600"))
    limits = langid.gate(docs.where("doc_id < 600"), langs, prototypes)
    kept = lambda texts: langid.filter_known(llm.createDataFrame([(t, 1) for t in texts], "text string, best int"), langs, prototypes, limits).count()
    assert kept([t for i, t, _ in rows if i >= 600]) >= 0.99 * 200
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), int(rng.integers(60, 400)))) for _ in range(100)]
    assert kept(junk) <= 2 and kept([text("fi") for _ in range(100)]) <= 10
    assert kept([None, "", "12 !"]) == 0
    nothing = langid.fit(docs.limit(0))
    assert langid.gate(docs.limit(0), *nothing).shape == (0, langid.SIZES)
    assert langid.filter_known(docs, *nothing, langid.gate(docs, *nothing)).count() == 0


# ---- op7 -------------------------------------------------------------------------------------------

def test_near_duplicates_match_brute_force(llm):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 6))
    vectors = [base[i % 12] + rng.normal(size=6) * 0.15 for i in range(200)]
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vectors)]
    rows += [(200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, [0.0] * 6, 0), (203, None, 0), (204, rows[0][1], None),
             (205, [float("inf")] * 6, 0), (206, [1.0, None], 0), (207, [1.0], 0), (208, [3.0], 0), (None, rows[0][1], 0)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ego_join.near_duplicates(table).collect()}
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows}
    for i, v, a in ok:
        for j, w, b in ok:
            if i != j and a == b and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93 - 1e-12:
                links[i].add(j)
    for i, n in links.items():
        seen, todo = {i}, [i]
        while todo:
            todo = [y for x in todo for y in links[x] if y not in seen and not seen.add(y)]
        assert got[i][0] == len(n), i
        assert i is None or got[i][1:] == (min(seen), min(seen) == i)
    assert got[None] == (0, None, False)
    assert ego_join.near_duplicates(table.limit(0)).count() == 0


# ---- op8 -------------------------------------------------------------------------------------------

def test_mix_targets_and_passes(llm):
    texts = ["w " * n for n in (100, 5, 40, 0, 7, 60, 3, 90, 2)] + [None, LONG]
    rows = curriculum.mix(documents(llm, texts)).collect()
    sizes = {None: 0, "s1": 0, "s2": 0}
    for k, t in enumerate(texts):
        sizes[["s1", "s2", None][k % 3]] += len(words(t))
    share, full, total = {"s1": 1, "s2": 2, None: 3}, {}, sum(sizes.values())
    while True:  # share again until no source is above its limit
        open_ = {s: w for s, w in share.items() if s not in full}
        target = {s: (total - sum(full.values())) * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: 3 * sizes[s] for s, t in target.items() if t >= 3 * sizes[s]}
        if not above:
            break
        full.update(above)
    for r in rows:
        assert r.target == pytest.approx({**target, **full}[r.source]) and 0 <= r.taken <= 3 * r.size
        assert r.size == len(words(texts[r.doc_id])) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(sum(r.taken for r in rows if r.source == s) - {**target, **full}[s]) < 1
    places = [r.position for r in rows if r.position is not None]
    assert places == sorted(places) and all(0 <= p <= 1 for p in places)
    assert sorted(rows, key=str) == sorted(curriculum.mix(documents(llm, texts).repartition(5)).collect(), key=str)
    passes = Counter({r.doc_id: r.passes for r in rows if r.passes})
    assert Counter(r.doc_id for r in curriculum.occurrences(documents(llm, texts)).collect()) == passes
    assert curriculum.mix(documents(llm, [])).count() == 0


def test_group_stage_keeps_one_row_of_each_group(llm):
    """Copies go whatever their ids: of one id, without an id, or of several; the smallest id stays."""
    words_ = lambda c: " ".join(f"{c}{k}" for k in range(40))
    texts = [words_("a")] * 4 + [words_("b")] * 4 + [words_("c")] * 3 + [words_("c") + " more", words_("d"), words_("e"), None, ""]
    ids = [7] * 4 + [None] * 4 + [None, 30, 20, 25, 9, 9, None, None]
    got = Counter((r.doc_id, r.text) for r in stages.keep_one_per_group(llm, documents(llm, texts, ids), "").collect())
    assert got == Counter([(7, words_("a")), (None, words_("b")), (20, words_("c")), (9, words_("d")), (9, words_("e")), (None, None), (None, "")])
    assert stages.keep_one_per_group(llm, documents(llm, []), "").count() == 0


def test_pipeline_stages_take_junk(llm):
    """Every stage on nulls, empty and very long texts, repeated and missing ids, and no rows."""
    for docs in (documents(llm, TEXTS + TEXTS, [None, 1, 1, *range(len(TEXTS) * 2 - 3)]), documents(llm, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(llm, docs, "")
            assert name == "byte_level_bpe" or out.columns == stages.COLUMNS
            assert out.count() <= docs.count() * curriculum.LIMIT


def test_mix_stage_reads_each_row_by_itself(llm):
    """Rows of one id, and rows without an id, are read as often as the mix says, not once for each other."""
    docs = documents(llm, [f"row{k} " * (10 + k) for k in range(12)], [7, None, None, 7, 7, None, 7, None, None, 7, 1, 2])
    passes = sum(r.passes for r in curriculum.mix(docs).collect())
    got = stages.mix_sources(llm, docs, "").collect()
    assert len(got) == passes and max(Counter(r.text for r in got).values()) <= curriculum.LIMIT
    assert {r.doc_id for r in got if r.text.startswith(("row1 ", "row2 "))} <= {None}


# ---- op9 -------------------------------------------------------------------------------------------

def nearest_by_force(index, texts, k=15):
    dense = np.zeros((index.ids.size, index.terms.size))
    word = np.repeat(np.repeat(np.arange(index.terms.size), np.diff(index.entries)), index.size)
    dense[index.doc, word] = index.weight
    row, word, weight = index.vectorise(toxicity.words_of(texts))
    place, cosine = index.nearest(len(texts), row, word, weight, k)
    for i in range(len(texts)):
        got = np.zeros(index.ids.size)
        for w, x in zip(word[row == i], weight[row == i]):
            got += dense[:, w] * x
        best = sorted(range(index.ids.size), key=lambda d: (-round(got[d], 12), index.ids[d]))[:k]
        assert np.allclose([got[d] if got[d] > 0 else 0 for d in best], cosine[i][: len(best)])
        assert [d for d in best if got[d] > 0] == [d for d in place[i].tolist() if d >= 0]


def test_bounds_never_hide_a_nearest_example():
    """Many blocks, ties between copies, words from rare to common: the same examples as all compared."""
    rng = np.random.default_rng(6)
    vocab = [f"w{i}" for i in range(3000)]
    draw = lambda: " ".join(vocab[int(i)] for i in np.minimum(rng.zipf(1.3, int(rng.integers(1, 40))) - 1, 2999))
    texts = [draw() for _ in range(700)]
    texts += texts[:60]
    label = np.array([int("w7" in t.split() or "w11" in t.split()) for t in texts])
    index = toxicity.build(np.arange(len(texts)) * 3, label, *toxicity.term_counts(toxicity.words_of(texts)))
    assert index.blocks > 10 and index.curve != (1.0, 0.0)
    nearest_by_force(index, [draw() for _ in range(80)] + texts[:20] + ["", "unknown"])


def test_toxic_words_beyond_the_commonest_are_found(llm):
    """Hundreds of marking words, each in few examples: none is left out."""
    rng = np.random.default_rng(7)
    plain = [f"p{i}" for i in range(400)]
    texts = [" ".join(rng.choice(plain, 30)) + (f" mark{i % 318} mark{(i + 60) % 318}" if i % 6 == 0 else "") for i in range(3000)]
    docs = documents(llm, texts)
    labels = llm.createDataFrame([(i, int(i % 6 == 0)) for i in range(2400)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert sum(got[i] for i in range(2400, 3000, 6)) >= 95  # of 100; 53 words mark them, none of them common
    assert sum(got[i] for i in range(2400, 3000) if i % 6) <= 5


def test_nearest_examples_match_brute_force(llm):
    rng = np.random.default_rng(5)
    vocab = [f"word{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocab, 12)) + (" nasty vile" if i % 4 == 0 else "") for i in range(200)]
    docs = documents(llm, texts + [None, "", LONG])
    labels = llm.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)] + [(None, 1), (151, None), (1, 0)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    assert index.ids.size == 150 and index.prior == pytest.approx(38 / 150)
    assert set(index.terms) == {h for r in toxicity.words_of(texts[:150]) for h in r}  # every word of the sample
    nearest_by_force(index, texts)
    got = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    toxic, clean = ([got[i].score for i in range(150, 200) if (i % 4 == 0) == t] for t in (True, False))
    assert sum(a > b for a in toxic for b in clean) > 0.9 * len(toxic) * len(clean)
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[200].score == got[201].score == pytest.approx(index.prior) and got[200].evidence == []
    assert all(got[i].evidence for i in range(200))  # a text that shares a word with an example has evidence
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


# ---- op10 ------------------------------------------------------------------------------------------

def test_main_text(llm):
    frame = ("<html><head><title>t</title><style>p{{}}</style><script>var x='</p>';</script></head><body><div class='x1'>Our site</div>"
             "<div class='x2'><p>Follow us today</p></div><section>{}</section><p>All rights kept</p></body>")
    article = ("<body><header>Top</header><nav><ul><li>a<li>b</ul></nav><article><h1>Head &amp; shoulders</h1><p><b>One\n two<br>three"
               "<p>Four&nbsp;five &lt;six&gt;<div class='ad box'>Buy</div><ul><li>p<li>q</ul><form>f<input></form>"
               "<section id=comments><p>nice</p></section></article><footer>end")
    rows = [(i, f"https://h.example/{i}", frame.format(f"<p>Story {'abcd'[i] * 3}</p>")) for i in range(4)]
    rows += [(10, "http://H2.example", article), (11, None, None), (12, "", ""), (13, "x", "<p>a < b</p><!-- c --><p>broken <i"), (10, "http://H2.example", article)]
    table = llm.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(1))
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.main_text(table).collect()}
    for i in range(4):
        assert got[i][0] == f"Story {'abcd'[i] * 3}"  # what every page of the host says is its template
    want = "Head & shoulders\nOne two three\nFour five <six>\np\nq"
    assert got[10] == (want, len(want))
    assert got[11] == got[12] == ("", 0) and got[13][0] == "a < b\nbroken"
    assert page_text.main_text(table).count() == len(rows) and page_text.main_text(table.limit(0)).count() == 0


def main_texts(spark, pages):
    table = spark.createDataFrame([(i, "http://h.example", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in page_text.main_text(table).orderBy("page_id").collect()]


def test_template_within_articles(llm):
    """A notice in every article of a host is its template; copies of one article are not."""
    page = "<body><article><h1>Title {0}</h1><p>Story {0}</p><div class=x><p>Follow us today</p></div></article></body>"
    assert main_texts(llm, [page.format(c * 3) for c in "abcd"]) == [f"Title {c * 3}\nStory {c * 3}" for c in "abcd"]
    copy = "<body><nav>menu {}</nav><article><h1>One title</h1><p>One story</p></article></body>"
    assert main_texts(llm, [copy.format(c * 3) for c in "abcd"]) == ["One title\nOne story"] * 4
    # copies do not outvote the other pages
    mixed = [page.format("aaa")] * 5 + [page.format(c * 3) for c in "bcd"]
    assert main_texts(llm, mixed) == [f"Title {c * 3}\nStory {c * 3}" for c in "aaaaabcd"]
    near = "<body><article><h1>One title</h1><p>One story told at length</p><p>changed {}</p></article></body>"
    assert main_texts(llm, [near.format(c * 3) for c in "abcd"]) == [f"One title\nOne story told at length\nchanged {c * 3}" for c in "abcd"]
    # a notice among paragraphs of which every page has another number
    varied = "<body><article id=post-{}><h1>Title {}</h1>{}<p>Follow us today</p></article></body>"
    stories = [[f"story {c}{k}" for k in range(n)] for n, c in enumerate("abcd", 1)]
    pages = [varied.format(n, n, "".join(f"<p>{t}</p>" for t in story)) for n, story in enumerate(stories)]
    assert main_texts(llm, pages) == ["\n".join([f"Title {n}", *story]) for n, story in enumerate(stories)]


def test_names_that_tell_a_state_keep_the_article(llm):
    """Names of a wrapper that hold a listed word are no reason to drop the article in it."""
    wraps = ["<body class='no-sidebar'><article>{}</article>", "<body class='sidebar'><article class='post comments-open'>{}</article>",
             "<html class='login'><main class='content has-sidebar search-page'>{}</main>", "<div class='content has-sidebar'>{}</div>",
             "<div id='overlay'><div class='widget'><article>{}</article></div></div><div class='related'><article>other</article></div>",
             "<article>{}</article><div id='comments'><article class='comment'>nice</article></div>",
             "<article>{}<div class='ad-banner'>Buy</div><p>the <span class='share links'>like</span></p></article>"]
    story = "<p>The story</p>"
    assert main_texts(llm, [w.format(story) for w in wraps]) == ["The story"] * 6 + ["The story\nthe like"]


def test_headings_over_slots_stay(llm):
    """Headings that every recipe of a host has are the article's; a repeated heading over nothing of its own is not."""
    page = ("<body><article><h1>Cake {0}</h1><h2>Ingredients</h2><ul><li>flour {0}</li></ul><h2>Method</h2><h3>First</h3><p>bake {0}</p>"
            "<h2>More from us</h2><p>Follow us today</p></article></body>")
    names = [c * 3 for c in "abcd"]
    assert main_texts(llm, [page.format(c) for c in names]) == [
        f"Cake {c}\nIngredients\nflour {c}\nMethod\nFirst\nbake {c}" for c in names]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>"])
def test_near_copies_keep_their_text(llm, wrap):
    """Pages of a host that differ in one paragraph are copies of one article, with or without an article element."""
    copy = ("<body><nav>menu</nav>" + wrap.format("<h1>One title</h1><p>A story told at length in every copy.</p><p>It goes on for long.</p>"
            "<p>changed {0}</p>") + "<footer>end</footer></body>")
    names = [c * 3 for c in "abcd"]
    assert main_texts(llm, [copy.format(c) for c in names]) == [
        f"One title\nA story told at length in every copy.\nIt goes on for long.\nchanged {c}" for c in names]


def test_the_slot_that_varies_most_is_the_article(llm):
    """Without article elements the template tells where the article is: other texts that vary from page to page are outside of it."""
    page = ("<body><div class='x1'><a href=/>home</a> <a href=/{0}>to {0}</a></div><div class='x2'>{1}<div class='x3'>{2}"
            "<p>Read more</p></div></div><div class='x4'><span>seen {0} times</span></div></body>")
    story = lambda c: [f"story of {c * 3} " + " ".join(c * k for k in range(2, 30)), f"more of {c * 4} at length, with all that belongs to it"]
    html_of = lambda c, title: page.format(c * 5, title, "".join(f"<p>{t}</p>" for t in story(c)))
    names = "abcde"
    assert main_texts(llm, [html_of(c, f"<h1>Title {c}</h1>") for c in names]) == ["\n".join([f"Title {c}", *story(c)]) for c in names]
    assert main_texts(llm, [html_of(c, "") for c in names]) == ["\n".join(story(c)) for c in names]
    # a page of the host that lacks the element is read as a whole
    assert main_texts(llm, [html_of(c, "") for c in names] + ["<body><p>Something else</p></body>"])[5] == "Something else"


def test_names_of_text_elements_tell_no_role(llm):
    """What a heading, paragraph or inline element is called says what it is about; adverts and hidden text go, the block stays whole."""
    pages = ["<article><h2 id='related'>Related work</h2><p class='search'>We search.</p><p>Say <span class='comment'>no <b>more</b></span> words.</p></article>",
             "<article><p>before <span class='ad'>Buy <span>two</span></span> after <b hidden>x</b>end</p><p class='advert'>Buy</p><p>next</p></article>",
             "<article><p>open <span class='ad'>never closed</p><p>next</p></article>"]
    assert main_texts(llm, pages) == ["Related work\nWe search.\nSay no more words.", "before after end\nnext", "open\nnext"]


def test_template_of_a_small_host_by_force(llm):
    """Tokens of equal counts on every page are one class: the same template as from whole occurrence vectors."""
    from collections import defaultdict
    rng = np.random.default_rng(8)
    part = lambda k, text: f"<div class='{'abcdefgh'[k]}'><p>{text}</p></div>"
    pages = []
    for i in range(9):
        body = "".join(part(k, f"fixed {k}") * (1 + (k == 2 and i % 2)) for k in range(6) if k < 4 or rng.random() < 0.6)
        pages.append(f"<body>{body}<section><p>own {'abcdefghi'[i] * 3}</p></section></body>")
    vectors = defaultdict(lambda: [0] * len(pages))
    for i, page in enumerate(pages):
        for kind, v in page_text.read(page):
            vectors[v[-1].token if kind == "open" else page_text.text_token(*v)][i] += 1
    classes = defaultdict(set)
    for token, vector in vectors.items():
        if sum(n > 0 for n in vector) >= max(page_text.MIN_PAGES, page_text.SHARE * len(pages)):
            classes[tuple(vector)].add(token)
    want = {t for c in classes.values() if len(c) >= page_text.MIN_CLASS for t in c}
    table = llm.createDataFrame([("h", p) for p in pages], "host string, html string")
    assert {t for r in page_text.templates(table).collect() for t in r.template} == want and len(classes) > 1


def test_ngram_join_links_a_group_of_near_copies_by_one_pair_a_node(spark, monkeypatch):
    """Copies share many tiles with different smallest nodes: what is walked for components grows with the nodes only."""
    walked = []

    def counting(edges):
        walked.append(edges.count())
        return components(edges)

    components = ngram_join.components
    monkeypatch.setattr(ngram_join, "components", counting)
    copies = 40
    texts = [" ".join("x" if w == 5 * k else f"w{w}" for w in range(200)) for k in range(copies)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = ngram_join.jaccard_groups(docs, width=4, percent=85).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(k, 0) for k in range(copies)}
    assert sum(walked) <= copies


def test_ngram_join_runs_few_tasks_on_few_rows_whatever_the_shuffle_partitions(spark):
    """Each task leaves shuffle, checkpoint and log files, so on small tables they must not grow with the partitions of every step."""
    texts = [" ".join("x" if w == 5 * (k % 20) else f"w{w + 1000 * (k // 20)}" for w in range(150)) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    for k, v in held.items():
        spark.conf.set(k, v)
    sc.setJobGroup("few-tasks", "op2 on 60 texts")
    try:
        rows = ngram_join.jaccard_groups(docs, width=4, percent=85).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {(r.doc_id, r.component_id) for r in rows} == {(k, k - k % 20) for k in range(60)}
    stages = {s for job in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(job).stageIds}
    assert sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i) <= 1000
