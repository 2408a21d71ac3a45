from corpus_helpers import SCHEMA, crc, frame, odd_rows, with_clashes

from threadlens.llm import language
from threadlens.llm.queries import op6_language

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = op6_language(spark, SF01).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(out) == len(truth)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in out)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_matches_a_plain_count(spark):
    """Gathered batch scores equal the log probabilities added one by one."""
    model = language.fit([("aa bb aa", "x"), ("cc dd cc", "y"), ("aa cc", "z")])
    for text in ("aa", "cc dd", "aa bb cc", "q"):
        z = model.prior + sum(model.log_prob[g].astype(float) for g in language.ngrams(text))
        lang, score = language.predict([text], model)
        assert lang[0] == model.languages[int(z.argmax())]
        assert 1 / len(model.languages) - 1e-9 <= score[0] <= 1


def test_odd_rows(spark):
    out = language.languages(with_clashes(frame(spark, odd_rows()))).collect()
    assert len(out) == len(odd_rows())
    pred = {r.doc_id: r.lang_pred for r in out}
    assert pred[1] == pred[2] == pred[3] == "und" and pred[4] == "en"
    assert language.languages(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = frame(spark, odd_rows()).selectExpr("doc_id", "text", "cast(null as string) lang", "source")
    assert {r.lang_pred for r in language.languages(nothing).collect()} == {"und"}
