"""Language of Latin-script texts from groups of two to four letters in them.

Profiles hold, for every language, a weight for each bucket of letter groups:
a hundred times the logarithm of its rate in sample texts, rounded, so that
sums are exact.  A text takes the language with the largest sum, if it is
ahead of the next by a margin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of letter groups; a power of two, so that a remainder is the lower bits.
BUCKETS = 8192
#: Two sums of weights, each below this, share a long; there are at most ``BUCKETS`` groups to a text.
HALF_BITS = 31
HALF = 1 << HALF_BITS
#: A language must lead by so much (a hundred is a factor of e), or it stays unknown.
MARGIN = 50

#: What the default profiles are learned from: our own short texts on everyday things and travel.
SAMPLES: dict[str, str] = {
    "en": """The morning was bright and the streets were still quiet when we left the station. Everyone has the right to rest and to
        spend some time with family and friends. You will find a small kitchen with everything you need, two large beds, a bath and a
        balcony that looks over the old town. Children are welcome and there is enough room for them to play in the yard. We would like
        our guests to feel at home, so please ask if anything is missing. The nearest shop is just around the corner, and the beach can
        be reached on foot within ten minutes. All human beings are born free and should act towards one another in a spirit of
        friendship. In winter it gets cold, but the living room has a warm stove. Many people who work here take the underground,
        which runs every five minutes through the whole day and most of the night. Light, quiet and newly furnished; the best place
        for those who want to see something of the country without being far from the city. What could be better than breakfast outside
        with a view of the sea and the mountains? Thank you very much for your interest.
        Rooms, flats, houses and cottages to let: bedroom, living room, bathroom, kitchen, loft, attic, studio, farm; lovely, cosy,
        sunny, spacious, charming, comfortable, private, shared, cheap, downtown, near the river, the lake, the airport, the
        university, the market.""",
    "de": """Am Morgen war es hell und die Straßen waren noch ruhig, als wir den Bahnhof verließen. Jeder Mensch hat das Recht auf
        Erholung und darauf, Zeit mit seiner Familie und mit Freunden zu verbringen. Sie finden eine kleine Küche mit allem, was Sie
        brauchen, zwei große Betten, ein Bad und einen Balkon, von dem man über die Altstadt blickt. Kinder sind willkommen und haben
        genug Platz, um im Hof zu spielen. Unsere Gäste sollen sich wie zu Hause fühlen, bitte fragen Sie also, wenn etwas fehlt. Das
        nächste Geschäft liegt gleich um die Ecke, und der Strand ist zu Fuß in zehn Minuten zu erreichen. Alle Menschen sind frei
        geboren und sollen einander freundlich begegnen. Im Winter wird es kalt, aber die Stube hat einen warmen Ofen. Viele Leute, die
        hier arbeiten, nehmen die Bahn, die den ganzen Tag und fast die ganze Nacht alle fünf Minuten fährt. Gut gelegen, sauber und
        neu eingerichtet; für alle, die etwas vom Land sehen möchten, ohne weit weg von der Stadt zu sein. Was könnte schöner sein als
        ein Frühstück draußen mit Blick auf das Meer und die Berge? Wir danken Ihnen herzlich für Ihr Interesse.
        Zimmer, Wohnungen, Häuser und Hütten zu vermieten: Schlafzimmer, Wohnzimmer, Küche, Dachgeschoss, Studio, Bauernhof; schön,
        gemütlich, sonnig, geräumig, reizend, bequem, eigen, geteilt, günstig, zentral, nahe am Fluss, am See, am Flughafen, an der
        Universität, am Markt.""",
    "fr": """Le matin était clair et les rues étaient encore calmes quand nous avons quitté la gare. Toute personne a droit au repos et
        peut passer du temps avec sa famille et ses amis. Vous trouverez une petite cuisine avec tout ce dont vous avez besoin, deux
        grands lits, une salle de bain et un balcon qui donne sur la vieille ville. Les enfants sont les bienvenus et ils ont assez de
        place pour jouer dans la cour. Nous voulons que nos hôtes se sentent chez eux, alors demandez s'il manque quelque chose. Le
        magasin le plus proche est juste au coin de la rue, et la plage est à dix minutes à pied. Tous les êtres humains naissent libres
        et doivent agir les uns envers les autres dans un esprit de fraternité. En hiver il fait froid, mais le salon a un poêle bien
        chaud. Beaucoup de gens qui travaillent ici prennent le métro, qui passe toutes les cinq minutes pendant la journée et une
        grande partie de la nuit. Propre, tranquille et meublé à neuf; pour ceux qui veulent découvrir le pays sans être trop loin du
        centre. Quoi de mieux qu'un petit déjeuner dehors avec vue sur la mer et les montagnes? Merci beaucoup de votre intérêt.
        Chambres, appartements, maisons et chalets à louer: chambre à coucher, salon, salle de bain, cuisine, grenier, ferme; beau,
        douillet, ensoleillé, spacieux, charmant, confortable, privé, partagé, bon marché, au centre, près de la rivière, du lac, de
        l'aéroport, de l'université, du marché.""",
    "es": """La mañana era clara y las calles todavía estaban tranquilas cuando salimos de la estación. Toda persona tiene derecho al
        descanso y a pasar tiempo con su familia y sus amigos. Usted encontrará una cocina pequeña con todo lo que necesita, dos camas
        grandes, un baño y un balcón que mira a la ciudad vieja. Los niños son bienvenidos y tienen bastante espacio para jugar en el
        patio. Queremos que nuestros huéspedes se sientan como en su hogar, así que pregunten si falta algo. La tienda más cercana está
        a la vuelta de la esquina, y se llega a la playa a pie en diez minutos. Todos los seres humanos nacen libres y deben comportarse
        fraternalmente los unos con los otros. En invierno hace frío, pero la sala tiene una estufa caliente. Mucha gente que trabaja
        aquí toma el metro, que pasa cada cinco minutos durante todo el día y casi toda la noche. Limpio, silencioso y con muebles
        nuevos; para quienes quieren ver algo del país sin estar lejos del centro. ¿Qué puede ser mejor que un desayuno fuera con vista
        al mar y a las montañas? Muchas gracias por su interés.
        Habitaciones, pisos, casas y cabañas en alquiler: dormitorio, salón, cuarto de baño, cocina, ático, estudio, granja; bonito,
        acogedor, soleado, amplio, encantador, cómodo, privado, compartido, barato, céntrico, cerca del río, del lago, del
        aeropuerto, de la universidad, del mercado.""",
    "it": """La mattina era chiara e le strade erano ancora tranquille quando siamo usciti dalla stazione. Ogni persona ha diritto al
        riposo e a passare del tempo con la famiglia e con gli amici. Troverete una piccola cucina con tutto quello che vi serve, due
        letti grandi, un bagno e un balcone che guarda sulla città vecchia. I bambini sono benvenuti e hanno abbastanza spazio per
        giocare nel cortile. Vogliamo che i nostri ospiti si sentano come a casa loro, quindi chiedete se manca qualcosa. Il negozio più
        vicino è proprio dietro l'angolo, e la spiaggia si raggiunge a piedi in dieci minuti. Tutti gli esseri umani nascono liberi e
        devono agire gli uni verso gli altri in spirito di fratellanza. D'inverno fa freddo, ma il soggiorno ha una stufa calda. Molta
        gente che lavora qui prende la metropolitana, che passa ogni cinque minuti per tutto il giorno e gran parte della notte. Pulito,
        silenzioso e arredato di recente; per chi vuole vedere qualcosa del paese senza essere lontano dal centro. Che cosa c'è di
        meglio di una colazione fuori con vista sul mare e sulle montagne? Grazie mille per il vostro interesse.
        Camere, appartamenti, case e baite in affitto: camera da letto, soggiorno, bagno, cucina, mansarda, monolocale, fattoria;
        bello, accogliente, soleggiato, spazioso, incantevole, comodo, privato, condiviso, economico, centrale, vicino al fiume, al
        lago, all'aeroporto, all'università, al mercato.""",
    "pt": """A manhã estava clara e as ruas ainda estavam calmas quando saímos da estação. Toda a pessoa tem direito ao descanso e a
        passar tempo com a sua família e os seus amigos. Encontrará uma cozinha pequena com tudo o que precisa, duas camas grandes, uma
        casa de banho e uma varanda que dá para a cidade velha. As crianças são bem-vindas e têm espaço suficiente para brincar no
        pátio. Queremos que os nossos hóspedes se sintam em sua casa, por isso perguntem se faltar alguma coisa. A loja mais próxima
        fica logo ao virar da esquina, e chega-se à praia a pé em dez minutos. Todos os seres humanos nascem livres e devem agir uns
        para com os outros em espírito de fraternidade. No inverno faz frio, mas a sala tem um fogão quente. Muitas pessoas que
        trabalham aqui vão de metro, que passa de cinco em cinco minutos durante todo o dia e quase toda a noite. Limpo, sossegado e com
        móveis novos; para quem quer ver um pouco do país sem ficar longe do centro. O que pode ser melhor do que um pequeno-almoço lá
        fora com vista para o mar e as montanhas? Muito obrigado pelo seu interesse.
        Quartos, apartamentos, casas e cabanas para alugar: quarto de dormir, sala, casa de banho, cozinha, sótão, estúdio, quinta;
        bonito, acolhedor, ensolarado, espaçoso, encantador, confortável, privado, partilhado, barato, central, perto do rio, do
        lago, do aeroporto, da universidade, do mercado.""",
    "nl": """De ochtend was helder en de straten waren nog stil toen we het station verlieten. Iedereen heeft recht op rust en mag tijd
        doorbrengen met zijn gezin en zijn vrienden. U vindt een kleine keuken met alles wat u nodig heeft, twee grote bedden, een
        badkamer en een balkon dat uitkijkt over de oude stad. Kinderen zijn welkom en hebben genoeg ruimte om op de binnenplaats te
        spelen. Wij willen dat onze gasten zich thuis voelen, dus vraag het gerust als er iets ontbreekt. De dichtstbijzijnde winkel is
        net om de hoek, en het strand is te voet in tien minuten te bereiken. Alle mensen worden vrij geboren en moeten zich tegenover
        elkaar broederlijk gedragen. In de winter wordt het koud, maar de woonkamer heeft een warme kachel. Veel mensen die hier werken
        nemen de trein, die de hele dag en bijna de hele nacht om de vijf minuten rijdt. Schoon, rustig en nieuw ingericht; voor wie
        iets van het land wil zien zonder ver van het centrum te zijn. Wat is er beter dan buiten ontbijten met uitzicht op zee en op de
        bergen? Hartelijk dank voor uw belangstelling.
        Kamers, appartementen, huizen en huisjes te huur: slaapkamer, woonkamer, badkamer, keuken, zolder, studio, boerderij; mooi,
        gezellig, zonnig, ruim, charmant, comfortabel, eigen, gedeeld, goedkoop, centraal, dicht bij de rivier, het meer, de
        luchthaven, de universiteit, de markt.""",
}

Profiles = dict[str, list[int]]

_default: dict[tuple, Profiles] = {}


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a column bound to a lambda's variable, so that no use computes it again."""
    return F.transform(F.array(c), use)[0]


def letter_groups(text: Column) -> Column:
    """Bucket of every two, three and four neighbours in the lower-cased letters of a text; words are set off by a blank.

    One array a row, empty without letters; rows are not exploded.  A group's
    bucket follows from that of the group one letter shorter, so each takes one step.
    """
    # One class, not alternatives: these would take a stack frame for every character of a run without letters.
    words = F.trim(F.regexp_replace(F.lower(text), r"[\P{L}\x{10000}-\x{10FFFF}]+", " "))
    chars = F.split(F.concat(F.lit(" "), words, F.lit("  ")), "")

    def longer(shorter: Column, codes: Column, size: int, shift: int) -> Column:
        """Buckets of ``size`` letters from those of one less: the same places, the letter that follows, and a shift."""
        return F.zip_with(F.slice(shorter, 1, F.size(codes) - (size - 1)), F.slice(codes, size, F.size(codes)), lambda g, c: (g * 31 + c + shift).bitwiseAND(F.lit(BUCKETS - 1)))

    def groups(codes: Column) -> Column:
        # Groups of three are shifted by 7 and those of four by 13, into which the shift of the three goes 31 times.
        return bound(longer(codes, codes, 2, 0), lambda two: bound(longer(two, codes, 3, 7), lambda three: F.concat(
            two, three, longer(three, codes, 4, (13 - 7 * 31) % BUCKETS))))

    found = bound(F.transform(chars, lambda c: F.ascii(c)), groups)
    return F.when(F.length(words) > 0, found).otherwise(F.array().cast("array<int>"))


def learn_profiles(samples: DataFrame) -> Profiles:
    """Profiles of a table ``lang, text``: one weight per language and bucket, whatever the number of rows.

    Texts without letters and null languages are passed over.
    """
    groups = samples.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.explode(letter_groups(F.col("text"))).alias("bucket"))
    counts = groups.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    weight = F.round(100 * F.log((F.col("n") + 0.5) / (F.col("total") + 0.5 * BUCKETS))).cast("int")
    rare = F.round(100 * F.log(F.lit(0.5) / (F.col("total") + 0.5 * BUCKETS))).cast("int")
    out: Profiles = {r["lang"]: [r["rare"]] * BUCKETS for r in total.select("lang", rare.alias("rare")).collect()}
    for r in counts.join(total, "lang").select("lang", "bucket", weight.alias("weight")).collect():
        out[r["lang"]][r["bucket"]] = r["weight"]
    return dict(sorted(out.items()))


def default_profiles(spark: SparkSession) -> Profiles:
    """Profiles of ``SAMPLES``, learned once."""
    key = tuple(SAMPLES.items())
    if key not in _default:
        _default[key] = learn_profiles(spark.createDataFrame(list(SAMPLES.items()), "lang string, text string"))
    return _default[key]


def latin_language(text: Column, profiles: Profiles, margin: int = MARGIN) -> Column:
    """The language whose profile gives a text the largest sum, NULL without letters or a lead of ``margin``."""
    def totals(groups: Column, weights: list[int]) -> Column:
        # One literal, made an array once when the plan is optimised.
        values = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<long>")
        return F.aggregate(groups, F.lit(0).cast("long"), lambda total, g: total + values[g])

    def scored(score: Column, lang: str) -> Column:
        return F.struct((-score).alias("s"), F.lit(lang).alias("lang"))

    def scores(groups: Column, langs: list[str]) -> Column:
        """Scores of one language, or of two whose weights, made positive, share the halves of a long."""
        least = min(min(profiles[lang]) for lang in langs)
        if len(langs) == 1 or max(max(profiles[lang]) for lang in langs) - least >= HALF // BUCKETS:
            return F.array(*[scored(totals(groups, profiles[lang]), lang) for lang in langs])
        both = totals(groups, [(a - least) * HALF + b - least for a, b in zip(*[profiles[lang] for lang in langs])])
        below = F.size(groups) * F.lit(least).cast("long")
        return bound(both, lambda t: F.array(scored(F.shiftright(t, HALF_BITS) + below, langs[0]),
                                              scored(t.bitwiseAND(F.lit(HALF - 1).cast("long")) + below, langs[1])))

    def best(groups: Column) -> Column:
        langs = list(profiles)
        ranked = F.sort_array(F.concat(*[scores(groups, langs[i:i + 2]) for i in range(0, len(langs), 2)]))
        return bound(ranked, lambda r: F.when(F.size(r) < 2, r[0]["lang"]).when(r[1]["s"] - r[0]["s"] >= margin, r[0]["lang"]))

    # Each group counts once, so that long texts cost little more than their letters.
    return bound(F.array_distinct(letter_groups(text)), lambda g: F.when(F.size(g) > 0, best(g)))
