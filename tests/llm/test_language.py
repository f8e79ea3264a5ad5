"""Languages of documents: held-out sentences, mixed texts, labels."""

from __future__ import annotations

import pytest

from mnemoweave.llm.language import document_languages, fitted, judge, known_labels, label_code, segments, sentences, wrong_labels

D = "/root/testdata/sf0.01"
TEXTS = {
    "en": "The old plan was kept, because nobody had read the second message. We will try the next one.", "de": "Der alte Plan wurde behalten, weil niemand die zweite Nachricht gelesen hat. Wir wollen es noch einmal versuchen.",
    "fr": "Le vieux plan est resté le même, parce que personne n'avait lu le deuxième message. Nous verrons bien.", "es": "El plan antiguo no cambió, porque nadie había leído el segundo mensaje. Ya veremos qué pasa.",
    "it": "Il vecchio piano è rimasto, perché nessuno aveva letto il secondo messaggio. Vediamo cosa succede.", "pt": "O plano antigo não mudou, porque ninguém tinha lido a segunda mensagem. Vamos ver o que acontece.",
    "nl": "Het oude plan is gebleven, omdat niemand het tweede bericht had gelezen. We zien wel wat er gebeurt.", "ru": "Старый план остался, потому что никто не прочитал второе сообщение. Посмотрим, что будет.", "ja": "誰も二番目の発言を読んでいないので、計画は変わりません。来週また試してみます。",
}


@pytest.fixture(scope="module")
def model(spark):
    return fitted(spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/languages.parquet"))


@pytest.mark.parametrize("lang", sorted(TEXTS))
def test_plain(model, lang):
    got = judge(model[0], TEXTS[lang])
    assert {g[2] for g in got} == {lang} and got[0][3] > 0.9
    assert {g[2] for g in judge(model[0], TEXTS[lang].upper())} == {lang}


@pytest.mark.parametrize("other", ["de", "fr", "ja", "pt", "ru"])
def test_mixed(model, other):
    got = judge(model[0], f"## Title of it\n\n{TEXTS['en']}\n\n{TEXTS[other]}\n\n{TEXTS['en']} (»per se«)")
    assert [g[2] for g in got] == ["en", other, "en"]


def test_no_sentence(model):
    for t in (None, "", " \n ", "## The old plan", "```\na = 1\nb = 2\n```", "|a|b|\n|-|-|\n|1|2|"):
        assert judge(model[0], t) == []


def test_sentences():
    t = "# Head\n- One two three.\n* Vier fünf! sechs sieben\n\n```\nx y z.\n```\n|a|b|"
    assert [t[a:b].strip() for a, b in sentences(t)] == ["One two three.", "Vier fünf!", "sechs sieben"]


def test_labels():
    codes = known_labels([("en", "English"), ("de", "German"), ("pt", "Portuguese")])
    assert [label_code(x, codes) for x in ("EN", "en-US", "en_GB", "eng", "English", " de ", "Deutsch", "ger", "pt-BR", "por")] == ["en"] * 5 + ["de"] * 3 + ["pt"] * 2
    assert [label_code(x, codes) for x in (None, "", " ", "xx", "und", "unknown", "auto", "n/a")] == [None] * 8


def test_rows(spark, model):
    both = TEXTS["en"] + "\n\n" + TEXTS["ru"]
    rows = [(1, TEXTS["en"], "en-US", "x"), (2, TEXTS["de"], "en", "x"), (3, both, "en", "x"), (4, None, "en", "x"), (5, "", None, "x"), (6, TEXTS["fr"], None, "x"), (7, TEXTS["en"] * 3000, "xx", "x"), (6, TEXTS["fr"], None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, segment_no string")
    found = segments(df, *model)
    assert sorted(tuple(r) for r in wrong_labels(found).collect()) == [(2, "de"), (3, "en"), (3, "ru"), (6, "fr"), (7, "en")]
    assert {r["doc_id"] for r in document_languages(found).collect()} == {1, 2, 3, 6, 7}
    assert segments(df.limit(0), *model).count() == 0


def test_held_out_labels(spark, model):
    """Most labels of the corpus are right; the documents' agreement with them shows that."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    wrong = wrong_labels(segments(docs.where("lang in ('de', 'en', 'es', 'fr', 'it', 'ja', 'nl', 'pt', 'ru') and length(text) > 20"), *model)).select("doc_id").distinct().count()
    assert wrong < 0.25 * docs.count()


def test_every_document(spark, model):
    """Documents without a sentence are judged by their words; those without a word stay, with none."""
    rows = [(1, "## Der alte Plan", "de"), (2, None, "en"), (3, " \n", None), (4, "12 34", "en"), (5, TEXTS["fr"], "fr"), (6, "|Старый|план|\n|-|-|\n|последнее|сообщение|", None), (7, TEXTS["en"] + "\n\n" + TEXTS["ru"], "en"), (2, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r["doc_id"], r["lang"]): r for r in document_languages(segments(df, *model, every=True), every=True).collect()}
    assert set(got) == {(1, "de"), (2, None), (3, None), (4, None), (5, "fr"), (6, "ru"), (7, "en"), (7, "ru")}
    assert got[1, "de"]["n_chars"] == 16 and got[1, "de"]["confidence"] > 0.5
    assert [(got[k]["confidence"], got[k]["n_chars"]) for k in ((2, None), (3, None), (4, None))] == [(0.0, 0)] * 3
    assert sorted(r["doc_id"] for r in wrong_labels(segments(df, *model)).collect()) == [7, 7]


def test_plan_keeps_every_document(spark, tmp_path):
    from mnemoweave.llm.plans.language import p8_documents

    d = spark.read.parquet(f"{D}/documents.parquet")
    more = spark.createDataFrame([(-1, "# Kurze Notiz", "de"), (-2, None, None)], "doc_id long, text string, lang string")
    d.limit(200).select("doc_id", "text", "lang").union(more).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{D}/languages.parquet").write.parquet(str(tmp_path / "languages.parquet"))
    ids = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "documents.parquet")).select("doc_id").collect()}
    assert {r["doc_id"] for r in p8_documents(spark, str(tmp_path)).collect()} == ids


def test_unseen_words(model):
    """Sentences of words that the sample hasn't are judged by their n-grams."""
    m = model[0]
    text = "Verzögerungslosigkeit beschleunigte Nachbarschaftlichkeiten."
    assert not any(w in m.words for w in text.lower().rstrip(".").split())
    assert [g[2] for g in judge(m, text)] == ["de"]
    assert judge(m, "A1 B22 333 4444 55555.") == []
