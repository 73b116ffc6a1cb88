"""Line-first quality rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportloom.llm.common import split_words

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
# A text that loses more than this share of its word characters is rejected.
MOST_LOST_PERCENT = 50

SYMBOLS = r"[^#*$%&|<>]+"
# Shares of a line's word characters, in percent.
MOST_SYMBOLS = 10
MOST_EXCLAIMED = 10
MOST_CAPITALS = 60
# Lines below that many letters are not judged by their capitals.
CAPITAL_LETTERS = 10
# Lines from that many words on need some punctuation.
BARE_WORDS = 30

# Phrases of page furniture, in English, German, French and Spanish. A letter
# outside ASCII stands in both cases, as not every engine folds it.
MENU_WORDS = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous", "back to top",
    "share", "contact us", "about us", "site map", "skip to content", "read more", "load more",
    "startseite", "men[üÜ]", "anmelden", "abmelden", "registrieren", "suche", "suchen", "weiter", "zur[üÜ]ck",
    "nach oben", "teilen", "kontakt", "impressum", "[üÜ]ber uns", "inhaltsverzeichnis", "zum inhalt springen",
    "weiterlesen", "mehr lesen", "mehr laden",
    "accueil", "connexion", "se connecter", "s.inscrire", "rechercher", "suivant", "pr[éÉ]c[éÉ]dent", "haut de page",
    "retour en haut", "partager", "contact", "contactez-nous", "[àÀ] propos", "plan du site", "aller au contenu",
    "lire la suite", "en savoir plus", "voir plus",
    "inicio", "men[úÚ]", "iniciar sesi[óÓ]n", "acceder", "registrarse", "buscar", "siguiente", "anterior",
    "volver arriba", "compartir", "contacto", "sobre nosotros", "mapa del sitio", "saltar al contenido",
    "leer m[áÁ]s", "ver m[áÁ]s", "cargar m[áÁ]s",
)
NOTICES = (
    "this (?:web)?site uses cookies", "accept (?:all )?cookies", "cookie policy", "privacy policy",
    "terms of (?:use|service)", "enable javascript", "javascript is (?:disabled|required)",
    "subscribe to our newsletter", "click here to", "lorem ipsum",
    "diese (?:web)?seite (?:verwendet|nutzt) cookies", "cookies akzeptieren", "cookie-richtlinie",
    "datenschutzerkl[äÄ]rung", "nutzungsbedingungen", "javascript (?:aktivieren|ist deaktiviert)",
    "newsletter abonnieren", "klicken sie hier",
    "ce site utilise des cookies", "accepter (?:tous )?les cookies", "politique de (?:cookies|confidentialit[éÉ])",
    "conditions d.utilisation", "activer javascript", "javascript est d[éÉ]sactiv[éÉ]",
    "abonnez-vous [àÀ] notre", "cliquez ici",
    "este sitio (?:web )?(?:utiliza|usa) cookies", "aceptar (?:todas las )?cookies",
    "pol[íÍ]tica de (?:cookies|privacidad)", "condiciones de uso", "t[éÉ]rminos (?:de uso|y condiciones)",
    "javascript est[áÁ] (?:desactivado|deshabilitado)", "suscr[íÍ]bete a nuestr[oa]", "ha(?:z|ga) clic aqu[íÍ]",
)
SEPARATED = r"([|»›•·][^|»›•·]{0,40}){4}"
# One menu word is all of the line, so its first letter tells most lines apart.
NAVIGATION = rf"(?i)^[ \t\r]*(?:{'|'.join(MENU_WORDS)})[ \t\r]*$"


def _by_first_letter(phrases: tuple[str, ...]) -> str:
    """A pattern of any of ``phrases`` that asks for each first letter once."""
    groups: dict[str, list[str]] = {}
    for phrase in phrases:
        groups.setdefault(phrase[0], []).append(phrase[1:])
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in groups.items())


BOILERPLATE = f"(?i)(?:{_by_first_letter(NOTICES)})"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _solid(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def bad_line(line: Column) -> Column:
    """Whether a line breaks a punctuation, navigation or boilerplate rule.

    Punctuation: over a tenth symbols or exclamation marks; mostly capitals; thirty
    words or more without any mark. Navigation: items between four or more bars or
    dots; a line that is one menu word. Boilerplate: phrases of page furniture. A
    blank line breaks none.
    """
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    symbols = F.length(F.regexp_replace(line, SYMBOLS, ""))
    exclaimed = F.length(F.regexp_replace(line, "[^!]+", ""))
    solid = _solid(line)
    return _bind(
        F.struct(solid.alias("all"), letters.alias("letters")),
        lambda of: (of["all"] > 0) & (
            (symbols * 100 > of["all"] * MOST_SYMBOLS)
            | (exclaimed * 100 > of["all"] * MOST_EXCLAIMED)
            | ((of["letters"] >= CAPITAL_LETTERS) & (capitals * 100 > of["letters"] * MOST_CAPITALS))
            | line.rlike(SEPARATED) | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)
            | (~line.rlike(r"[.,;:!?…]") & line.rlike(r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % (BARE_WORDS - 1)))
        ),
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that occur twice or more, the first included.

    Windows compare by 64 bits to find out whether any repeats, by 128 to say which.
    """
    positions = F.when(F.size(words) >= window, F.sequence(F.lit(0), F.size(words) - window)).otherwise(
        F.array().cast("array<int>")
    )

    def hashed(i: Column, *first: Column) -> Column:
        return F.xxhash64(*first, *[F.get(words, i + k) for k in range(window)])

    def covered(order: Column) -> Column:
        def equal(e: Column, i: Column) -> Column:
            other = F.get(order, i)
            return F.coalesce((e["a"] == other["a"]) & (e["b"] == other["b"]), F.lit(False))

        twice = F.filter(order, lambda e, i: equal(e, i - 1) | equal(e, i + 1))
        places = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return _bind(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(window)), F.lit(window))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        ))

    ordered = F.sort_array(
        F.transform(positions, lambda i: F.struct(
            hashed(i).alias("a"), hashed(i, F.lit(1)).alias("b"), i.alias("i")
        ))
    )
    any_twice = _bind(F.transform(positions, lambda i: hashed(i)), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(any_twice, _bind(ordered, covered)).otherwise(F.lit(0).cast("long"))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED_PERCENT, most_lost: int = MOST_LOST_PERCENT,
) -> DataFrame:
    """Columns ``doc``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``lost_chars`` (word characters of lines that break
    a rule), ``cleaned`` (the text without them) and ``kept``; one row per row of ``docs``.

    A text fails the base below ``least_words`` words or with more than ``most_repeated``
    percent repeated words; else it is kept unless it loses more than ``most_lost``
    percent of its word characters. Null and empty texts fail the base and clean to an
    empty text; texts may be of any length; repeated rows each have a row; an empty
    table gives no rows; other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    lines = F.split("text", "\n", -1)
    filled = F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = rows.select(
        "doc",
        _bind(split_words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")
        )).alias("w"),
        _solid(F.col("text")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        _bind(filled, lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long")).alias("n_dup_lines"),
        _bind(F.transform(lines, lambda x: F.struct(bad_line(x).alias("bad"), x.alias("line"))), lambda f: F.struct(
            F.array_join(F.transform(F.filter(f, lambda x: ~x["bad"]), lambda x: x["line"]), "\n").alias("cleaned"),
            _solid(F.array_join(F.transform(F.filter(f, lambda x: x["bad"]), lambda x: x["line"]), "\n"))
            .cast("long").alias("lost_chars"),
        )).alias("c"),
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    done = counted.select(
        "doc", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "c.lost_chars", "c.cleaned"
    ).withColumn("base_failed", failed)
    return done.withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= most_lost * F.col("word_chars"))
    )
