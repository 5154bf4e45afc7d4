import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from waybill.llm import language
from waybill.llm.language import accepted, fit, identify, learn, text_codes


def test_codes_of_words():
    """Contexts end with the word, and neighbours do not matter."""
    a, b = ord("a"), ord("b")
    codes, borders = text_codes(pa.array(["ab", None, "", "1 A, b", "ab"]))
    lists = [codes[low:high].tolist() for low, high in zip(borders[:-1], borders[1:])]
    word = [a, a << 16 | b, a << 32 | b << 16]
    assert lists == [word, [], [], [a, a << 16, b, b << 16], word]
    # Letters in codes count only where there are no others.
    codes, borders = text_codes(pa.array(["3ab7 ab b9", "a1", "12", "ab"]))
    lists = [codes[low:high].tolist() for low, high in zip(borders[:-1], borders[1:])]
    assert lists == [word, [a, a << 16], [], word]


def test_words_go_on_over_combining_marks():
    for word in ("हिन्दी", "ที่นี่", "مُحَمَّد", "e\u0301te\u0301"):
        codes, borders = text_codes(pa.array([word]))
        assert (codes & 0xFFFF).tolist() == [*map(ord, word), 0] and len(borders) == 2


def test_marks_alone_are_no_text():
    codes, borders = text_codes(pa.array(["\u0301\u0301 \u0e34", "a \u0301", "\u0301 1a", "é"]))
    assert np.diff(borders).tolist() == [0, 4, 2, 2]
    assert set(codes.tolist()) >= {ord("a"), 0x301, ord("é")}


def test_characters_beyond_16_bits_and_upper_case():
    codes, _ = text_codes(pa.array(["𐐀", "𐐨", "Ǆ", "ǆ", "İ"]))
    first = codes[codes & 0xFFFF > 0].tolist()
    assert first[0] == first[1] and 0xE000 <= first[0] < 0xE000 + 6400 and first[2] == first[3]


def test_languages_of_one_script(documents):
    """Letters that one alphabet lacks tell languages apart that share most words' shapes."""
    texts = {
        "uk": "Усі люди народжуються вільними і рівними у своїй гідності та правах. Їм належить діяти у дусі братерства, "
              "його їжа та її діти є тут, цієї ночі з'явилися зірки",
        "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Им надлежит поступать в духе братства, "
              "его еда и ее дети здесь, этой ночью появились звезды",
        "bg": "Всички хора се раждат свободни и равни по достойнство и права. Те трябва да се отнасят в дух на братство, "
              "неговата храна и нейните деца са тук, тази нощ се появиха звезди",
        "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待这里有很多孩子和老师",
        "ja": "すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である人間は理性と良心とを授けられて",
    }
    rows = [(i, text, lang, "s") for i, (lang, text) in enumerate(list(texts.items()) * 4)]
    identifier = learn(documents(rows), (F.col("doc_id") % 4 == 3).cast("int"))
    asked = [("uk", "рівними та вільними є їхні діти"), ("ru", "свободными и равными появились дети"),
             ("bg", "свободни и равни са нейните деца"), ("zh", "自由平等和权利"), ("ja", "自由である権利について")]
    found = identify(documents([(i, text) for i, (_, text) in enumerate(asked)]), identifier).collect()
    assert [row.lang_pred for row in sorted(found)] == [lang for lang, _ in asked]


def test_models_have_a_bound(documents):
    levels = {("a", 0): {0: 90, 1: 9, 5: 1}, ("b", 0): {0: 3}}
    assert language.least_counts(levels, 1000) == {("a", 0): 1, ("b", 0): 1}
    assert language.least_counts(levels, 20) == {("a", 0): 2, ("b", 0): 1}
    assert language.least_counts(levels, 4) == {("a", 0): 4, ("b", 0): 2}
    docs = documents([(i, "the same words again and again " + chr(0x4E00 + i) * 3, "en", "s") for i in range(40)])
    whole, small = learn(docs, F.col("doc_id") % 2), learn(docs, F.col("doc_id") % 2, entries=100)
    assert len(small.models["en"].grams[3]) <= 100 < len(whole.models["en"].grams[3])
    assert identify(docs, small).filter("lang_pred = 'en'").count() == 40


def test_beyond_the_bound_all_ngrams_count(documents):
    """Models that do not go to all executors are tables, which give the same results."""
    random = np.random.default_rng(2)
    alphabets = {"de": "abcdeß", "en": "abcdef", "zh": [chr(0x4E00 + i) for i in range(50)]}
    rows = [(i, " ".join("".join(random.choice(list(alphabets[lang]), random.integers(1, 7))) for _ in range(30)), lang, "s")
            for i, lang in enumerate([*alphabets] * 20)]
    rows += [(90, "", "de", "s"), (91, None, "en", "s"), (92, "12 !?", None, "s"), (0, "abc 12x zz щ", None, "s"), (0, "abc", "fr", "s")]
    docs, fold = documents(rows), (F.col("doc_id") % 3 == 0).cast("int")
    whole, small = learn(docs, fold), learn(docs, fold, entries=50)
    assert whole.tables is None and small.tables is not None and whole.spread.keys() == small.spread.keys()
    for lang, values in whole.spread.items():
        assert np.allclose(values, small.spread[lang], rtol=1e-9)
    keep = ("doc_id", "text")
    found = [sorted(identify(docs, one, keep).collect(), key=lambda row: (row.doc_id, row.text or "")) for one in (whole, small)]
    assert [(*row[:3], row.rejected) for row in found[0]] == [(*row[:3], row.rejected) for row in found[1]]
    assert np.allclose(*[[(row.score, row.cross_entropy) for row in one] for one in found], rtol=1e-9)
    assert accepted(docs, small).count() == accepted(docs, whole).count()


def kneser_ney(counts):
    """Interpolated Kneser-Ney by its formula; n-grams are tuples, the predicted class last."""
    levels = {4: counts}
    for order in (3, 2, 1):
        levels[order] = Counter(gram[1:] for gram in levels[order + 1])
    rebates = {}
    for order, level in levels.items():
        ones, twos = (sum(v == k for v in level.values()) for k in (1, 2))
        rebates[order] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def chance(gram):
        if not gram:
            return 2 ** -16
        level, rebate = levels[len(gram)], rebates[len(gram)]
        total = sum(v for g, v in level.items() if g[:-1] == gram[:-1])
        if not total:
            return chance(gram[1:])
        kinds = sum(g[:-1] == gram[:-1] for g in level)
        return max(level.get(gram, 0) - rebate, 0) / total + rebate * kinds / total * chance(gram[1:])

    return chance


def test_model_against_the_formula():
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("abcde"), 4)) for _ in range(80)]
    codes, _ = text_codes(pa.array([" ".join(words)]))
    keys, counts = np.unique(codes, return_counts=True)
    model = fit(keys, counts)

    def gram(code):
        return tuple(int(code) >> shift & 0xFFFF for shift in (48, 32, 16, 0))

    chance = kneser_ney({gram(k): int(c) for k, c in zip(keys, counts)})
    a = ord("a")
    asked = np.array([*keys, a, a + 1 << 16 | a + 4, a << 48 | a + 1 << 32 | a + 2 << 16 | a + 3,
                      9 << 48 | a + 1 << 32 | a + 2 << 16 | a, 60], np.uint64)
    for code, log in zip(asked, model.log2(asked)):
        assert math.isclose(2 ** log, chance(gram(code)), rel_tol=1e-9)
    # Every context leaves a proper distribution.
    context = int(keys[len(keys) // 2]) >> 16 << 16
    following = np.uint64(context) + np.arange(1 << 16, dtype=np.uint64)
    assert math.isclose(np.exp2(model.log2(following)).sum(), 1, rel_tol=1e-9)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    found = identify(docs, learn(docs, F.when(fold.isin(0, 1), 0).when(fold == 3, 1)), ("doc_id", "lang"))
    held = found.filter(fold == 2).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")),
                                          F.avg(F.col("rejected").cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.98 and held[1] < 0.01 and 0 <= held[2] <= held[3] <= 1


def test_edge_rows(documents, clashing):
    german, english = "der die und straße über ", "the and street over with "
    rows = [(i, text * 9, lang, "s") for i, (text, lang) in enumerate([(german, "de"), (english, "en")] * 12)]
    rows += [(90, None, "de", "s"), (91, german, None, "s"), (92, "", "en", "s"), (None, english, "en", "s")]
    docs = documents(rows)
    identifier = learn(docs, F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0))
    asked = [(1, None), (2, ""), (3, "12 !?"), (4, "straße"), (4, "straße"), (5, english * 9000), (6, "zqxj " * 60),
             (None, "the and"), (7, "щжфы ".upper() * 40)]
    found = identify(clashing(documents(asked), "Score", "rejected"), identifier, ("doc_id", "Score", "rejected"))
    assert found.columns == ["doc_id", "Score", "rejected", "lang_pred", "score_", "cross_entropy", "rejected_"]
    by_id = {(r.doc_id, r.lang_pred, r.rejected_) for r in found.collect()}
    assert by_id == {(1, "und", True), (2, "und", True), (3, "und", True), (4, "de", False), (5, "en", False),
                     *((i, lang, True) for i, lang, _ in by_id if i in (6, 7)), (None, "en", False)}
    kept = accepted(documents(asked), identifier)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "None"]
    assert identify(documents([]), identifier).count() == 0


def test_nothing_to_learn_from(documents):
    identifier = learn(documents([]), F.lit(0))
    row = identify(documents([(1, "text")]), identifier).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
