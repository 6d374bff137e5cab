import pytest
from pyspark.sql import functions as F

from presslens import catalog
from presslens.functions import text as X
from presslens.sources import items as S
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(same, name):
    same(catalog.QUERIES[name], catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["quality_gate", "page_texts"])
def test_queries_without_sql_keep_their_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_bound_computes_once_and_keeps_null(spark):
    assert value(spark, X.bound(F.lit("ab"), lambda x: F.concat(x, x))) == "abab"
    assert value(spark, X.bound(F.lit(None).cast("string"), F.upper)) is None


@pytest.mark.parametrize(("text", "want"), [(None, ""), ("", ""), ("A plain sentence.", "A plain sentence"), ("no stop at all", "no stop at all")])
def test_strip_boilerplate_takes_closing_marks_only(spark, text, want):
    assert value(spark, X.strip_boilerplate(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("text", "want"), [(None, "unknown"), ("", "unknown"), ("Привет мир", "ru"), ("hello world", "en"), ("12345", "other")])
def test_detect_language(spark, text, want):
    assert value(spark, X.detect_language(F.lit(text).cast("string"))) == want


def test_page_fields(spark):
    long = "A paragraph of more than sixty characters that says what happened here today."
    html = F.lit(f'<title>Head &amp; tail</title><nav><p>{long} nav</p></nav><p>{long}</p><p>short</p><img src="https://x.example/logo.png"><img src="https://x.example/a.jpg">')
    assert value(spark, S.page_title(html)) == "Head & tail"
    assert value(spark, S.page_text(html)) == long
    assert value(spark, S.page_photo(html)) == "https://x.example/a.jpg"
    assert value(spark, S.page_photo(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []),
        ("", []),
        ("no end", ["no end"]),
        ("Один случай. Другой случай!  Без точки", ["Один случай.", "Другой случай!", "Без точки"]),
        ("А. С. Пушкин родился в 1799. Он писал.", ["А. С. Пушкин родился в 1799.", "Он писал."]),
    ],
)
def test_sentences(spark, text, want):
    assert value(spark, X.sentences(F.lit(text).cast("string"))) == want


def test_sentence_cut(spark):
    long = "Слово за словом. " * 100
    assert value(spark, X.sentence_cut(F.lit(long))) == long[: 1300 // 17 * 17]
    assert value(spark, X.sentence_cut(F.lit("а" * 1400))) == "а" * 1300
    assert value(spark, X.sentence_cut(F.lit("short. text"))) == "short. text"
    assert value(spark, X.sentence_cut(F.lit(None).cast("string"))) is None


def column(spark, values, use):
    """``use`` of each value, by one job."""
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", use(F.col("v")).alias("out")).collect()
    return [r["out"] for r in sorted(rows, key=lambda r: r["k"])]


POLISH = [
    (None, ""),
    ("", ""),
    ("Aug. 21 (UPI) -- Storm hits the coast.", "Storm hits the coast."),
    ("Aug. 21 (UPI) -- Madrid, 20 ago (EFE).- Texto completo.", "Texto completo."),
    ("Бишкек, 21.08.26 /Кабар/. Президент подписал закон.", "Президент подписал закон."),
    ("Redacción Deportes, 21 ago (EFE).- Gana el equipo.", "Gana el equipo."),
    ("— Storm hits the coast. |", "Storm hits the coast."),
    ("Вид на завод сверху. Снимок сделан (Фото Getty Images) вчера. Завод закрыли на ремонт.", "Завод закрыли на ремонт."),
    ("Только подпись (Фото Getty Images).", "Только подпись (Фото Getty Images)."),
    ("First words. Second words. Third words. Photo by someone. Fifth words.", "First words. Second words. Third words. Photo by someone. Fifth words."),
    ("Rider is seen at the start. The race was won by two seconds.", "The race was won by two seconds."),
    ("Девушка держит табличку у входа. Суд отложил заседание.", "Суд отложил заседание."),
    ("Rider " + "x" * 220 + " is seen there. The race was won.", "Rider " + "x" * 220 + " is seen there. The race was won."),
    ("Data: Bureau; Chart: Axios Visuals Prices rose again.", "Prices rose again."),
    ("Цены выросли. Подробности от издания", "Цены выросли."),
    ("Prices rose. Read more...", "Prices rose."),
    ("A finished phrase without a stop", "A finished phrase without a stop."),
    ("Short sentence. It ends with the", "Short sentence. It ends with the"),
    ("A long first sentence that goes on until it has passed the eightieth character of all. It ends with the", "A long first sentence that goes on until it has passed the eightieth character of all."),
    ("A long first sentence that goes on until it has passed the eightieth character of all. By Edward J", "A long first sentence that goes on until it has passed the eightieth character of all."),
    ("Two  spaces   here.", "Two spaces here."),
]
CLEAN = [
    (None, ""),
    ("a&nbsp;b &eacute; &#8217; &#x2019; &amp;lt; &unknown; &#0;", "a b é ’ ’ &lt; &unknown; \ufffd"),
    ("&lt;b&gt;bold&lt;/b&gt; text", "bold text"),
    ('<a title="x > y" href="z">link</a> after', "link after"),
    ('data-image-caption="(Foto: A / B)" data-large-file="https://x.jpg?fit=1280"/>News', "News"),
    ("zero\u200bwidth\xa0space", "zerowidth space"),
    ("a > b", "a b"),
    ("  many \n\t spaces ", "many spaces"),
    ("AT&T & R&D", "AT&T & R&D"),
]


def test_polish(spark):
    assert column(spark, [t for t, _ in POLISH], X.polish) == [w for _, w in POLISH]


def test_clean_text(spark):
    assert column(spark, [t for t, _ in CLEAN], X.clean_text) == [w for _, w in CLEAN]


INNER = [
    ("The big bridge closed", "Word. The big, BRIDGE  closed! Rest here", "Word. Rest here"),
    ("The big bridge closed", "The big bridge closed. The big bridge closed.", "The big bridge closed."),
    ("The big bridge", "Before the big bridge after", "Before the big bridge after"),
    ("Мост закрыт на ремонт", "Фото.  Мост закрыт — на ремонт", "Фото.  Мост закрыт — на ремонт"),
    ("Мост закрыт на ремонт", "Фото. Мост закрыт на ремонт, сообщили", "Фото. сообщили"),
    ("The big bridge closed", "", ""),
    ("The big bridge closed", None, None),
    (None, "a  b", "a  b"),
    ("- - - -", "a  b", "a  b"),
    ("The big bridge closed", "The big bridge", "The big bridge"),
]


def test_inner_titles(spark):
    from presslens.operators import gate

    rows = spark.createDataFrame([(k, t, b) for k, (t, b, _) in enumerate(INNER)], "k int, t string, b string").select("k", gate.drop_inner_title(F.col("t"), F.col("b")).alias("out")).collect()
    assert [r["out"] for r in sorted(rows, key=lambda r: r["k"])] == [w for _, _, w in INNER]


FEED = "source string, quota int, category string, priority int, scope string, lang string, native string, xml string"
ENTRY = "<item><title>{title}</title><link>http://x</link><description>{body}</description>{more}</item>"


def test_feeds(spark):
    def feed(source, *entries, quota=9, lang=None, native=None, end="</channel></rss>"):
        return source, quota, "NEWS", 0, "world", lang, native, '<rss xmlns:media="m"><channel>' + "".join(ENTRY.format(**{"title": "A title", "body": "text", "more": ""} | e) for e in entries) + end

    rows = [
        feed("quota", {"title": ""}, {}, {}, quota=2),  # the quota counts before titles are looked at
        feed("none", {}, quota=0),
        feed("broken", {}, end="</rss>"),
        feed("boring", {"title": "Брифинг в министерстве"}),
        feed("russian", {"title": "English title"}, {"title": "Русский заголовок"}),
        feed("latin", {"body": "An English text in a Russian feed that is long enough"}, lang="ru"),
        feed("native", {"body": "An Uzbek text in Latin letters that is long enough"}, lang="ru", native="uz"),
        feed("spanish", {"body": "Un texto"}, lang="es"),
        feed("sound", {"more": '<enclosure type="audio/mpeg" url="http://a.mp3"/><media:content url="http://v.mp4" medium="video" width="2000"/><media:content url="http://w.jpg" width="wide"/><media:thumbnail url="http://t.jpg"/>'}),
        feed("thumb", {"more": '<media:thumbnail url="http://t.jpg" width="900"/><media:content url="http://c.webp" width="300"/>'}),
        feed("enclosed", {"more": '<enclosure type="image/png" url="http://e"/><media:content url="http://c.jpg" width="3000"/>'}),
        ("null", 5, "NEWS", 0, "world", None, None, None),
        ("empty", 5, "NEWS", 0, "world", None, None, ""),
    ]
    got = S.rss_items(spark.createDataFrame(rows, FEED), 77, ("russian",)).collect()
    assert sorted((r["source"], r["title"], r["language"], r["imageUrl"], r["imageLowRes"]) for r in got) == sorted(
        [
            ("quota", "A title", "en", None, False),
            ("russian", "Русский заголовок", "ru", None, False),
            ("latin", "A title", "en", None, False),
            ("native", "A title", "uz", None, False),
            ("spanish", "A title", "es", None, False),
            ("sound", "A title", "en", "http://w.jpg", True),
            ("thumb", "A title", "en", "http://t.jpg", False),
            ("enclosed", "A title", "en", "http://e", False),
        ]
    )
    assert {r["publishedAt"] for r in got} == {77}
