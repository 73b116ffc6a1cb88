"""Phrases of page furniture in four languages, by Spark and by DuckDB alike."""

import duckdb

from reportloom.llm import quality_rules

BAD = [
    "Startseite", "Über uns", "über uns", "ZURÜCK", "Zum Inhalt springen", " Weiterlesen \r", "À propos", "S'inscrire",
    "S’inscrire", "Lire la suite", "PRÉCÉDENT", "Menú", "Iniciar sesión", "LEER MÁS", "Back to top",
    "Diese Webseite verwendet Cookies, mehr dazu hier.", "Unsere Datenschutzerklärung, Stand heute.",
    "Ce site utilise des cookies, bien sûr.", "Lisez la Politique de confidentialité, svp.", "Abonnez-vous à notre lettre.",
    "Este sitio web utiliza cookies, claro.", "POLÍTICA DE PRIVACIDAD, versión 2", "Haz clic aquí, por favor.",
]
GOOD = [
    "Die Suche nach dem Weg dauerte lange.", "Wir kamen weiter, als wir dachten.", "Le menu du jour est bon, et le vin aussi.",
    "Il a voulu en savoir plus, puis il est parti.", "El siguiente día, la casa estaba vacía.", "Cookies schmecken gut.",
    "Une politique de santé, enfin.", "Home is where the heart is.", "",
]


def test_furniture_in_four_languages(spark):
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(BAD + GOOD)], "i int, line string")
    found = lines.select("i", quality_rules.bad_line(lines["line"]).alias("bad")).orderBy("i").collect()
    assert [r["bad"] for r in found] == [True] * len(BAD) + [False] * len(GOOD)
    for line in BAD + GOOD:
        seen = duckdb.execute(
            "SELECT regexp_matches(?, ?) OR regexp_matches(?, ?)",
            [line, quality_rules.NAVIGATION, line, quality_rules.BOILERPLATE],
        ).fetchone()[0]
        assert seen is (line in BAD)
