"""The default vocabulary of field crops and what moves them, by theme and language, and patterns of many terms.

A term is bounded by word edges unless a star opens it at that end: ``trigo`` is that word alone, ``pszenic*`` all its forms, ``*weizen*`` its compounds too. Words that mean something else in another
of these languages, or in everyday use, stand only in compounds or phrases that tell them apart. The list is composed here. ``read_words`` loads one of the caller's own,
which replaces it, by substrings, wherever a function takes ``default`` or ``keywords``.
"""

from __future__ import annotations

import re
from pathlib import Path

#: Theme and language, then terms between commas.
_THEMES = """
cereals en: wheat, durum, corn, maize, barley, rye, oat, oats, rice, paddy, sorghum, millet, triticale, cereal, cereals, grain, grains, small grains
cereals fr: blé, blés, blé dur, maïs, orge, orges, avoine, seigle, riz, sorgho, céréale*
cereals de: *weizen*, gerste*, *gerste, roggen*, haferernte, haferanbau, maisernte, maisanbau, körnermais, silomais, *getreide*
cereals es: trigo, maíz, cebada, centeno, arroz, avena, cereal*
cereals pt: milho, cevada, centeio, aveia, sorgo
cereals it: frumento, grano duro, grano tenero, granturco, mais ibrido, orzo, risone, cerealicol*
cereals pl: pszenic*, pszenż*, kukurydz*, jęczmie*, owies, żyto, żyta, zbóż*, zboż*
cereals cs: pšenic*, kukuřic*, ječmen*, ječmene, žito, oves, obilí, obilovin*
cereals sv: *vete, höstvete*, korn och havre, maltkorn, havre*, spannmål*
cereals nl: tarwe*, *tarwe, gerst, wintergerst, graan, granen, snijmaïs, korrelmaïs
cereals fi: vehnä*, ohra, ohran, ohraa, kaura*, ruista, vilja, viljan*, viljasato*
cereals hu: búza*, *búza, kukoric*, árpa, árpát, zab, gabon*
cereals ro: grâu, grâului, porumb*, orz, orzului, ovăz*, secară, cereale*
cereals uk: пшениц*, кукурудз*, ячмен*, ячмін*, жито, зерн*
cereals tr: buğday*, mısır üretim*, mısır ekim*, arpa, arpada, çavdar*, yulaf*, tahıl*, hububat*
cereals ar: *قمح*, *ذرة*, *شعير*, *حبوب*
oilseeds en: soy, soya, soybean*, canola, rapeseed*, oilseed rape, sunflower*, oilseed*, groundnut*, peanut*, linseed
oilseeds fr: colza, tournesol*, soja, oléagineux
oilseeds de: winterraps, rapssaat, rapsernte, rapsöl, rapsanbau, sonnenblume*, ölsaat*, sojabohne*
oilseeds es: girasol*, oleaginos*
oilseeds pt: girassol, oleaginosa*
oilseeds it: girasole, semi oleosi
oilseeds pl: rzepak*, słonecznik*
oilseeds cs: řepk*, slunečnic*
oilseeds sv: höstraps, vårraps, rapsfrö, solros*, oljeväxt*
oilseeds nl: koolzaad*, zonnebloem*
oilseeds fi: rypsi*, rapsin, öljykasv*
oilseeds hu: repce*, napraforgó*
oilseeds ro: rapiț*, floarea-soarelui, floarea soarelui
oilseeds uk: ріпак*, соняшник*, сої, соя, сою
oilseeds tr: ayçiçeği*, kanola*
others en: cotton, sugar beet*, sugarbeet*, sugarcane, sugar cane, potato, potatoes, pulses, lentil*, chickpea*, field peas, faba bean*, alfalfa, silage, coffee crop, coffee harvest
others fr: coton, betterave*, pomme de terre, pommes de terre, lentille*, féverole*, luzerne
others de: zuckerrübe*, kartoffel*, ackerbohne*, körnererbse*, luzerne*
others es: algodón, remolacha*, caña de azúcar, papa y batata, garbanzo*
others pt: algodão, cana-de-açúcar, feijão
others pl: burak* cukrow*, ziemniak*, bawełn*
others uk: буряк*, картопл*, бавовн*
others tr: pamuk*, pancar*, patates*
field en: crop, crops, cropping, acreage, harvest, harvests, harvested, harvesting, planting season, plantings, planted area, sowing, sown, crop yield*, yield forecast*, yields of, arable, farmland, growing season
field fr: récolte*, moisson*, semis, emblavement*, rendements, grandes cultures, assolement*
field de: ernte, erntemenge*, ernteprognose*, ernteschätzung*, aussaat*, anbaufläche*, ackerbau*, landwirtschaft*
field es: cosecha*, siembra*, cultivos, superficie sembrada
field pt: safra, safras, colheita*, plantio, lavoura*
field it: raccolto di, raccolti, semine, seminativi, coltivazion*
field pl: żniw*, plony, plonów, plonowani*, upraw*, zasiew*, zbiory
field cs: skliz*, úrod*, osev*
field sv: skörd*, *skörd, sådd, vårsådd, höstsådd
field nl: oogst*, *oogst, akkerbouw*
field fi: kylvö*, sadonkorjuu*, satoennuste*
field hu: aratás*, vetés*, termésátlag*, szántóföld*
field ro: recolt*, semănat*, însămânț*
field uk: врожа*, урожа*, посівн*, посіву
field tr: hasat, hasadı, rekolte*, ekim alan*, bitkisel üretim*
field ar: *محصول*, *محاصيل*, *حصاد*
inputs en: pesticide*, herbicide*, fungicide*, insecticide*, crop protection, plant protection product*, biopesticide*, biocontrol, biostimulant*, seed treatment*, glyphosate, neonicotinoid*, fertiliser*, fertilizer*, urea, potash, phosphate*, ammonium nitrate, gene-edited seed*, seed trait*
inputs fr: engrais, phytosanitaire*, semence*, désherbant*
inputs de: *dünger*, pflanzenschutz*, saatgut*
inputs es: fertilizante*, plaguicida*, fitosanitari*, semillas
inputs pt: defensivo* agrícola*, adubo*
inputs it: concim*, fitofarmac*, sementi
inputs pl: nawoz*, nawóz*, środk* ochrony roślin
inputs cs: hnojiv*, osiv*
inputs sv: gödsel*, konstgödsel, växtskydd*, utsäde*
inputs nl: kunstmest*, gewasbescherming*, zaaizaad*
inputs fi: lannoit*, kasvinsuojelu*, siemenvilj*
inputs hu: műtrágy*, növényvédő*, vetőmag*
inputs ro: îngrășămin*, erbicid*
inputs uk: добрив*, гербіцид*, насіння
inputs tr: gübre*, tohum, tohumluk*
inputs ar: *أسمدة*
weather en: drought*, frost damage, late frost*, heatwave*, heat wave*, hailstorm*, monsoon*, el niño, el nino, la niña, la nina, soil moisture, flooded field*, waterlog*
weather fr: sécheresse*, gel tardif, gelées tardives, grêle, canicule agricole
weather de: dürre*, spätfrost*, hagelschäden, bodenfeuchte
weather es: sequía*, heladas, granizo
weather pt: estiagem, geada*
weather it: siccità, gelate tardive, grandinat*
weather pl: susza, suszy, suszą, przymrozk*
weather hu: aszály*
weather ro: secetă, secetei
weather uk: посух*, заморозк*
weather tr: kuraklık*, zirai don
weather ar: *جفاف*
trade en: export ban*, export quota*, grain export*, grain deal, import tariff*, wheat tender*, farm bill, common agricultural policy, farm subsid*, agricultural subsid*, food security
trade fr: exportations de blé, politique agricole commune, souveraineté alimentaire
trade de: agrarpolitik, exportverbot
trade es: retenciones al agro, política agrícola
biofuels en: biofuel*, biodiesel, bioethanol, ethanol, renewable diesel, sustainable aviation fuel, biomethane, biogas, crush margin*, oilseed crush*
biofuels fr: biocarburant*, agrocarburant*
biofuels de: biokraftstoff*
biofuels es: biocombustible*, biodiésel
context en: agriculture, agricultural, agribusiness*, agrochemical*, agronom*, precision farming, crop rotation*, cover crop*, soil health, irrigation, irrigated, farm supply, commodity market*
context fr: agricole*, agronomi*, filière céréalière, irrigation
context de: agrarmarkt*, fruchtfolge*
context es: agropecuari*, riego
"""


def _read() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for line in _THEMES.strip().splitlines():
        head, _, words = line.partition(":")
        found.setdefault(head.split()[0], []).extend(w for w in (x.strip() for x in words.split(",")) if w)
    return found


#: Terms by theme.
THEMES = {theme: list(dict.fromkeys(words)) for theme, words in _read().items()}
DEFAULT_KEYWORDS = list(dict.fromkeys(w for words in THEMES.values() for w in words))


def read_words(path: str) -> list[str]:
    """Words of a text file, one to a line; blank lines and lines that begin with # don't count."""
    lines = (line.strip() for line in Path(path).read_text(encoding="utf-8").splitlines())
    return list(dict.fromkeys(line for line in lines if line and not line.startswith("#")))


_EDGE = r"[^\p{L}\p{N}]"


def _factored(words: set[str]) -> str:
    """One pattern of all the words, in which words that begin alike share their beginning; the longest comes first."""
    heads: dict[str, set[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], set()).add(w[1:])
    parts = []
    for head, rests in sorted(heads.items()):
        while len(rests) == 1 and (rest := next(iter(rests))) and rest[0] != "*":
            head, rests = head + rest[0], {rest[1:]}
        inner = _factored(rests)
        parts.append(r"[\p{L}\p{N}]*" + inner if head == "*" else re.escape(head) + inner)
    if not parts:
        return ""
    return parts[0] if len(parts) == 1 and "" not in words else "(?:" + "|".join(parts) + ")" + ("?" if "" in words else "")


def _shortest(words: set[str]) -> set[str]:
    """Without words that begin with another one: where ends are open, these decide nothing."""
    return {w for w in words if not any(w[:n] in words for n in range(1, len(w)))}


def term_pattern(terms: list[str]) -> str:
    """A pattern, for Java's and RE2's syntax, that finds any of the terms in a lower-cased text: a trie for each kind of bounds. A star within a term stands for the rest of a word."""
    whole, opened, inside, ending = set(), set(), set(), set()
    for term in (t.lower() for t in terms if t.strip("* ")):
        body = term.strip("*")
        (inside if term[0] == term[-1] == "*" else ending if term[0] == "*" else opened if term[-1] == "*" else whole).add(body)
    edge, parts = f"(?:^|{_EDGE})", []
    if whole or opened:
        some = ([f"{_factored(whole)}(?:{_EDGE}|$)"] if whole else []) + ([_factored(_shortest(opened))] if opened else [])
        parts.append(f"{edge}(?:{'|'.join(some)})")
    if inside:
        parts.append(_factored(_shortest(inside)))
    if ending:
        parts.append(f"{_factored(ending)}(?:{_EDGE}|$)")
    return "|".join(parts)
