"""The vocabulary on labelled lines, and factored patterns against trying each term."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import filters
from millrace.vocabulary import DEFAULT_KEYWORDS, THEMES, term_pattern

#: Lines that belong to the subject, of every theme and language of the vocabulary.
ABOUT = """
Wheat futures rise on Black Sea tensions|Corn planting gains pace in Iowa|U.S. soybeans end higher|Barley export ban lifted|New herbicide approved in Brazil|Urea prices jump|El Niño threatens rice in Asia
Farm bill talks stall|EU biofuel mandate raised|Sustainable aviation fuel plant opens|Late frost hits orchards and crops|Heatwave cuts crop yields in Spain|Cover crops pay off|Irrigation limits in California|Potato growers face blight
La récolte de blé tendre s'annonce record|Les moissons commencent en Beauce|Sécheresse : les éleveurs inquiets|Colza : semis en retard|Engrais : les prix flambent|Le maïs souffre|L'orge de brasserie recule|Les semences certifiées
Winterweizen: Bestände gut entwickelt|Die Ernte ist eingefahren|Rapsernte 2026 enttäuscht|Zuckerrüben leiden unter Dürre|Neue Düngeverordnung und Mineraldünger|Pflanzenschutz: Zulassung läuft aus|Getreidepreise steigen|Die Aussaat stockt
La cosecha de trigo crece|Sequía golpea al girasol|Siembra de maíz avanza|Retenciones al agro bajan|Precios de fertilizantes|Safra de soja recorde|Plantio do milho avança|Geada atinge lavouras de café|Algodão: colheita começa
Frumento duro, quotazioni in calo|Siccità: semine a rischio|Concimi più cari|Zbiory pszenicy wyższe|Ceny rzepaku spadły|Susza niszczy uprawy|Nawozy drożeją|Sklizeň pšenice začala|Ceny řepky klesají|Hnojiva zdražila
Höstvete och korn|Skörden blev rekordstor|Spannmålspriser stiger|Gödselpriserna stiger|De tarweoogst begint|Koolzaad onder druk|Kunstmest duurder|Akkerbouwers klagen|Vehnän hinta nousi|Rypsin kylvöt alkoivat|Lannoitteet kallistuivat
Megkezdődött az aratás|Emelkedik a búza ára|A kukoricatermés gyenge|Aszály sújtja a földeket|Recolta de grâu a scăzut|Porumbul suferă|Secetă severă în sud|Îngrășămintele s-au scumpit|Експорт пшениці зріс|Посівна розпочалася|Врожай соняшнику|Ціни на добрива
Buğday üretimi arttı|Hasat başladı|Gübre fiyatları yükseldi|Kuraklık riski|Ayçiçeği ekimi|أسعار القمح ترتفع|حصاد الذرة في مصر|أسمدة جديدة|الجفاف يهدد المحاصيل
"""

#: Lines that don't, many with words that hold or resemble a term.
NOT_ABOUT = """
Le ministre parle, mais rien ne change|A gorge and a river|Storage of forged money|La culture populaire à l'honneur|Bond yields fall as Fed pauses|The company will trait its rivals|He wraps up the tour|Rapper drops new song, raps about fame
Hummus recipe wins prize|Le rire est bon|Il riso abbonda sulla bocca degli stolti|The striker scored twice|Parliament votes on pensions|New phone launched|Der Lehrer lernte viel|Sie entfernten das Plakat|Die Mais GmbH meldet Insolvenz|Er ist gern ernst
El ministro de cultura dimite|El granizado está rico|La seca respuesta del juez|Museo abre sus puertas|O ministro fala|A copa do mundo|Il concerto di domenica|La semantica del testo|Koncert w Warszawie|Wyniki wyborów|Hokej: Sparta vyhrála|Nový film v kinech
Han vet inte|Regeringen faller|De minister treedt af|Een nieuwe brug|Hallitus kaatui|Uusi elokuva|A kormány döntött|Új film a mozikban|Guvernul a căzut|Film nou la cinema|Уряд подав у відставку|Новий фільм|Hükümet istifa etti|Yeni film vizyonda|الحكومة تستقيل|فيلم جديد
Microsoft buys game studio|Hotel chain expands|Airline strikes continue|The price of gold|Semiconductor output rises|Supreme court ruling|Royal visit to Canada|Train services resume|Storm over the lawsuit|Insulation grants|Boatyard opens|Goats on the loose|Bryce wins
"""


def lines(text):
    return [x.strip() for row in text.strip().split("\n") for x in row.split("|")]


def test_vocabulary_on_labelled_lines(spark):
    rows = [(x, True) for x in lines(ABOUT)] + [(x, False) for x in lines(NOT_ABOUT)]
    df = spark.createDataFrame(rows, "title string, about boolean")
    found = {r["title"]: r["hit"] for r in df.select("title", filters.contains_terms(F.col("title"), DEFAULT_KEYWORDS).alias("hit")).collect()}
    good = sum(found[t] for t, about in rows if about)
    bad = [t for t, about in rows if not about and found[t]]
    precision, recall = good / (good + len(bad)), good / len(lines(ABOUT))
    print(f"{len(rows)} lines, precision {precision:.3f}, recall {recall:.3f}, wrong {bad}, missed {[t for t, about in rows if about and not found[t]]}")
    assert precision >= 0.97 and recall >= 0.95
    assert set(THEMES) == {"cereals", "oilseeds", "others", "field", "inputs", "weather", "trade", "biofuels", "context"}


def plain_match(term, text):
    """One term by itself."""
    body = r"[^\W_]*".join(map(re.escape, term.strip("*").split("*")))
    left, right = "" if term.startswith("*") else r"(?<![^\W_])", "" if term.endswith("*") else r"(?![^\W_])"
    return re.search(left + body + right, text) is not None


@pytest.mark.parametrize("seed", range(3))
def test_factored_pattern_is_each_term(spark, duck, seed):
    """Terms that begin alike, contain each other and hold characters of patterns, in Java's and RE2's syntax."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(["a", "b", "é", ".", "(", " ", "+", "-", "л"]) for _ in range(rng.randrange(1, n))).strip()
    terms = [t for t in {rng.choice(["", "*"]) + w + rng.choice(["", "*"]) for w in (word(6) for _ in range(60)) if w and w[0] not in ".(+-" and w[-1] not in ".(+-"}] + ["a*b", "*(+*"]
    texts = [word(25) for _ in range(400)]
    pattern = term_pattern(terms)
    want = [any(plain_match(t, x) for t in terms) for x in texts]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").coalesce(1).select("i", filters.contains_terms(F.col("x"), terms).alias("hit")).collect()
    assert [r["hit"] for r in sorted(got)] == want
    assert [duck.execute("SELECT regexp_matches(?, ?)", [x, pattern]).fetchone()[0] for x in texts] == want
    assert any(want) and not all(want)


def test_no_terms(spark):
    df = spark.createDataFrame([("x",), (None,)], "x string")
    assert [r[0] for r in df.select(filters.contains_terms(F.col("x"), [])).collect()] == [False, False]
    assert [r[0] for r in df.select(filters.contains_any(F.col("x"), ["", "X"])).collect()] == [True, False]


def test_time_grows_little_with_the_terms(spark, sf_dir):
    """A thousand terms take at most twice the time of ten."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(1000)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").repartition(8).persist()
    docs.count()

    def took(terms):
        best = 1e9
        for _ in range(4):
            began = time.perf_counter()
            docs.where(filters.contains_terms(F.col("text"), terms)).count()
            best = min(best, time.perf_counter() - began)
        return best

    few, many = took(words[:10]), took(words)
    docs.unpersist()
    print(f"10 terms {few:.3f} s, 1000 terms {many:.3f} s")
    assert many <= 2 * few + 0.05
