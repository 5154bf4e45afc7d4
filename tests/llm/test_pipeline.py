import hashlib
import math
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_mixing, test_near_dedup, test_pseudonyms
from waybill.llm import pseudonyms

GONE = ["", "1234 !? ...", None, "zqxj vkqz jqzx " * 60]


def fixture_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    start = max(row[0] for row in rows) + 1
    rows += [(start + i, text, None, "src1", len(text or "")) for i, text in enumerate(GONE)]
    # Copies with changed letters' case are one document, and so are repeated rows.
    rows += [(start + 10 + i, row[1].upper(), *row[2:]) for i, row in enumerate(rows[:5]) if row[1].isascii()]
    rows += [rows[0], rows[7]]
    return rows


def brute_pseudonyms(text, key):
    def put(match):
        found = match.group()
        if "@" in found:
            return test_pseudonyms.brute_mail(found)
        if re.fullmatch(pseudonyms.ADDRESS, found):
            return test_pseudonyms.brute_address(found)
        if re.fullmatch(pseudonyms.CARD, found):
            return test_pseudonyms.brute_card(found) if test_pseudonyms.luhn(re.sub(r"\D", "", found)) else found
        return test_pseudonyms.brute_phone(found)

    return re.sub(pseudonyms.ANY, put, text, flags=re.ASCII)


def brute(rows):
    """The stages one after the other, in plain Python; languages are known from how the fixture was made."""
    gone = {text for text in GONE}
    rows = [row for row in rows if row[1] not in gone]
    distinct = list(dict.fromkeys(rows))
    kept = {i for i, _, _, keeps in test_near_dedup.brute([(row[0], row[1]) for row in distinct]) if keeps}
    rows = [row for row in distinct if row[0] in kept]
    assert not any(re.search(r"\d{4}-\d\d-\d\d|\d{3}-\d\d-\d{4}|\d\d/\d\d/\d{4}", row[1]) for row in rows)
    rows = [(row[0], brute_pseudonyms(row[1], corpus_pipeline.PSEUDONYM_KEY), *row[2:]) for row in rows]
    sizes = Counter(row[3] for row in rows)
    weight = {source: math.sqrt(size) for source, size in sizes.items()}
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    found = Counter()
    for i, text, lang, source, _ in rows:
        rate = len(rows) * weight[source] / (sum(weight.values()) * sizes[source])
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        found[i, lang, source, len(ids), digest] += test_mixing.brute_copies(i, rate, corpus_pipeline.MIXING_SEED)
    return +found


def test_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(test_pseudonyms, "KEY", corpus_pipeline.PSEUDONYM_KEY)
    rows = fixture_rows(spark)
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.lang, r.source, r.n_tokens, r.ids_sha256) for r in found) == brute(rows)


def test_stages_keep_the_columns(spark, documents, clashing):
    docs = clashing(documents([(1, "the text of one is here"), (2, "and the text of two"), (None, None), (3, "")]),
                    "score", "copy", "n_mail", "_key", "ids")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, "")
        assert made.columns == docs.columns and made.dtypes == docs.dtypes, name
        made.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 4


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
