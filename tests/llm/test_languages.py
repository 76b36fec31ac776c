from kinfold.llm import languages
from kinfold.llm.mail import body_of, repair

CODES = [("en", "en"), ("EN", "en"), ("de", "de"), ("fr", "fr"), ("", None), ("und", None)]
EN = "The front desk moved the meeting to room 5. We are waiting for an answer to this question. Nobody told us that it was late."
DE = "Die Nachtschicht hat das Paket nicht bekommen. Wir warten auf eine Antwort von Ihnen. Bitte geben Sie uns noch einmal Bescheid."
HI = "Humein is par baat karni chahiye. Aapke dhairya ke liye bahut dhanyavaad hai. Yeh suchi mein nahi hai aur hum intezaar kar rahe hain."
DEVA = "हमें इस पर बात करनी चाहिए। रात की पाली ने पार्सल लेने से मना किया।"
MAIL = "From: a@b.example\nSubject: Die Rechnung ist da. Bitte sofort zahlen. Wir warten auf Sie.\nContent-Type: multipart/mixed; boundary=\"=_x\"\n\n--=_x\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: quoted-printable\n\n{}\n--=_x\nContent-Type: text/plain\nContent-Disposition: attachment; filename=a.txt\n\n{}\n--=_x--\n"


def run(spark, docs):
    d = spark.createDataFrame([(i, t, l, "x", "x") for i, t, l in docs], "doc_id bigint, text string, lang string, label string, langs string")
    c = spark.createDataFrame(CODES, "label string, lang string").selectExpr("*", "1 as doc_id")
    found = sorted(tuple(r) for r in languages.relabelled(d, c).collect())
    return found, languages.detect(d, c).collect(), languages.segments(d, c).collect()


def test_labels(spark):
    docs = [
        (1, EN, "EN"), (2, EN, "de"), (3, DE, None), (4, EN + "\n\n" + DE, "en"), (5, HI, "und"), (6, DEVA, ""), (7, None, "en"), (8, "", "en"), (9, " \n ", None),
        (10, MAIL.format(EN, DE), "en"), (11, MAIL.format(EN.replace("The", "=54he"), DE), "fr"), (12, "> " + DE.replace(". ", ".\n> "), "de"), (None, DE, "en"),
        (13, "ID: KL-1\nRef: 77", "en"),
    ]
    found, langs, segs = run(spark, docs)
    assert found == [(2, "en"), (3, "de"), (4, "de"), (4, "en"), (5, "hi"), (6, "hi"), (11, "en")]
    assert all(0.5 <= r["confidence"] <= 1 for r in langs)
    four = [(r["lang"], r["first"], r["last"]) for r in segs if r["doc_id"] == 4]
    assert four == [("en", 0, 2), ("de", 3, 5)]


def test_repeated_rows_and_very_long(spark):
    found, _, _ = run(spark, [(1, EN, "de"), (1, EN, "de"), (2, " ".join([DE] * 3000), "en"), (3, "word " * 100_000, "en")])
    assert found == [(1, "en"), (2, "de")]


def test_words_behind_long_headers_are_learned(spark):
    """The fit reads whole texts: what stands behind 7,000 characters teaches words too."""
    long = "Received: from x\n" * 450 + "\n" + "Qibblewort zanduvia mirfolex prindolan. " * 20
    d = spark.createDataFrame([(i, long, "fr") for i in range(5)] + [(9, EN, "en")], "doc_id bigint, text string, lang string")
    scores = languages._fitted(d, spark.createDataFrame(CODES, "label string, lang string"))
    assert scores["qibblewort"][languages.LANGS.index("fr")] == 0


def test_empty(spark):
    assert run(spark, [])[0] == []


def test_body():
    assert body_of(None) == "" and body_of("plain words") == "plain words"
    b = body_of(MAIL.format("k=C3=B6nnen Sie", "attached"))
    assert "können Sie" in b and "attached" not in b and "Rechnung" not in b
    assert repair("fÃ¼r KÃ¶ln") == "für Köln" and repair("déjà vu") == "déjà vu"
    html = "Content-Type: text/html; charset=utf-8\n\n<html><style>p {a}</style><p>One &amp; two</p></html>"
    assert body_of(html).split() == ["One", "&", "two"]


def test_held_out_accuracy(spark):
    """Most labels of the archive are right; a model that is any good agrees with most."""
    from kinfold.sources.tables import table

    d = "/root/testdata/sf0.01"
    docs, codes = table(spark, d, "documents"), table(spark, d, "lang_codes")
    langs = languages.detect(docs, codes).where("sentences >= 2").select("doc_id", "lang").withColumnRenamed("lang", "found")
    stored = docs.join(codes.withColumnRenamed("lang", "code"), docs.lang == codes.label).where("code is not null").select("doc_id", "code")
    j = stored.join(langs, "doc_id").groupBy("doc_id").agg({"code": "first", "found": "collect_set"}).collect()
    right = sum(r[1] in r[2] for r in j) / len(j)
    assert right > 0.9
