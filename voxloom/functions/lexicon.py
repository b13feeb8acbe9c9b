"""Word lists of Hebrew number spelling and text rewriting.

Fixed values: the results depend on each of them, so they stand here as plain text.
"""

# 0 to 19, then tens, hundreds and thousands by their count; an empty string is an unused place
UNITS_F = (
    "אפס", "אחת", "שתיים", "שלוש", "ארבע", "חמש", "שש", "שבע", "שמונה", "תשע",
    "עשר", "אחת עשרה", "שתים עשרה", "שלוש עשרה", "ארבע עשרה", "חמש עשרה", "שש עשרה", "שבע עשרה", "שמונה עשרה", "תשע עשרה",
)
UNITS_M = (
    "אפס", "אחד", "שניים", "שלושה", "ארבעה", "חמישה", "שישה", "שבעה", "שמונה", "תשעה",
    "עשרה", "אחד עשר", "שנים עשר", "שלושה עשר", "ארבעה עשר", "חמישה עשר", "שישה עשר", "שבעה עשר", "שמונה עשר", "תשעה עשר",
)
TENS = (
    "", "", "עשרים", "שלושים", "ארבעים", "חמישים", "שישים", "שבעים", "שמונים", "תשעים",
)
HUNDREDS = (
    "", "מאה", "מאתיים", "שלוש מאות", "ארבע מאות", "חמש מאות", "שש מאות", "שבע מאות", "שמונה מאות", "תשע מאות",
)
THOUSANDS = (
    "", "אלף", "אלפיים", "שלושת אלפים", "ארבעת אלפים", "חמשת אלפים", "ששת אלפים", "שבעת אלפים", "שמונת אלפים", "תשעת אלפים",
    "עשרת אלפים",
)
ORDINALS_F = (
    "", "ראשונה", "שנייה", "שלישית", "רביעית", "חמישית", "שישית", "שביעית", "שמינית", "תשיעית",
    "עשירית",
)
ORDINALS_M = (
    "", "ראשון", "שני", "שלישי", "רביעי", "חמישי", "שישי", "שביעי", "שמיני", "תשיעי",
    "עשירי",
)
MILLION, BILLION = "מיליון", "מיליארד"
AND, MINUS, POINT = "ו", "מינוס", "נקודה"
MORNING, AFTERNOON, AND_HALF, AND_QUARTER = "בבוקר", "אחר הצוהריים", "וחצי", "ורבע"
TWO_OF_M, TWO_OF_F = "שני", "שתי"
# 0.5 alone; "times"; "hundred", which ends "century"
HALF, TIMES, HUNDRED = "חצי", "פי", "מאה"

# symbol after a number: word and its gender
SYMBOL_UNITS = {
    "%": ("אחוז", "m"), "°": ("מעלות", "f"), "₪": ("שקלים", "m"), "$": ("דולר", "m"), "€": ("אירו", "m"),
}
# letters that may precede a number, in the order in which they are tried; one entry is two run together, and one is absent
PREPOSITIONS = (
    "מ-", "ש-", "ה-", "ו-", "כ-", "ל-", "ב-", "מה-", "מכ-", "שמ-",
    "שה-", "שכ-", "של-", "שב-", "ומ-", "וש-", "וה-", "וכ-", "ול-", "וב-",
    "כש-", "וכש-", "כשה-", "כשמ-", "כשב-", "כשבכ-לכ-", "בכ-", "כשבכ-", "כשלכ-", "שכ-",
    "של-", "שב-",
)
# unit after a number; all are masculine
UNIT_WORDS = {
    "km": "קילומטר", "m": "מטר", "cm": "סנטימטר", "mm": "מילימטר", "kg": "קילוגרם", "g": "גרם",
    "ml": "מיליליטר", "l": "ליטר", "L": "ליטר", "GB": "גיגה בייט", "Mb": "מגה ביט", "MB": "מגה בייט",
    "%": "אחוז",
}
# degrees: feminine
DEGREES = {
    "°C": "מעלות", "°F": "מעלות פרנהייט",
}
ABBREVIATIONS = {
    'רו"ח': "רואה חשבון", 'עו"ד': "עורך דין", 'ד"ר': "דוקטור", "פרופ'": "פרופסור", "מס'": "מספר", "רח'": "רחוב",
    'בע"מ': "בעמ", 'ת"א': "תל אביב", 'מע"מ': "מעמ",
}
# one-letter words that may precede an abbreviation
ABBREVIATION_PREFIXES = ("ה", "ו", "ב", "ל", "כ", "מ")
# months 1 to 12
MONTHS = (
    "לראשון", "לשני", "לשלישי", "לרביעי", "לחמישי", "לשישי", "לשביעי", "לשמיני", "לתשיעי", "לעשירי",
    "לאחד עשר", "לשנים עשר",
)
FIRST_OF_MONTH = "הראשון"

PLURAL_M, PLURAL_F, THE = "ים", "ות", "ה"
MASCULINE_NOUNS = frozenset({
    "אחוז", "אירו", "דולר", "חודש", "יום", "מטר", "מילימטר", "סנטימטר", "קילוגרם", "קילומטר",
    "שבוע", "שקל",
})
# plurals that end like masculine ones and are feminine, and the other way round
FEMININE_PLURALS = frozenset({
    "אבנים", "ביצים", "גפנים", "דבורים", "דבלים", "דרכים", "יונים", "כבשים", "כינים", "מחטים",
    "מילים", "נשים", "עדשים", "עיזים", "ערים", "פילגשים", "פנינים", "פעמים", "ציפורים", "צפרדעים",
    "שיבולים", "שנים", "שקמים", "תאנים", "תולעים",
})
MASCULINE_PLURALS = frozenset({
    "אבות", "אולמות", "אוצרות", "אורות", "אותות", "אילנות", "אסונות", "ארונות", "אריות", "ארמונות",
    "בורות", "ביזיונות", "גבולות", "גגות", "גייסות", "גיליונות", 'דו"חות', "דורות", "דיברות", "וילונות",
    "זיכרונות", "זנבות", "חלומות", "חלונות", "חלזונות", "חסרונות", "חשבונות", "חשדות", "חששות", "יינות",
    "יתרונות", "כוחות", "כינורות", "כיסאות", "כסאות", "לוחות", "לילות", "מוחות", "מוסדות", "מזלגות",
    "מזלות", "מחוזות", "מחנות", "מטבעות", "מכרות", "מלונות", "מסעות", "מעונות", "מעיינות", "מעמדות",
    "מקומות", "מקורות", "משקאות", "נהרות", "ניירות", "נרות", "סודות", "סולמות", "ספקות", "עופות",
    "עורות", "עפרונות", "עקרונות", "פיקדונות", "פירות", "פתרונות", "צבאות", "צינורות", "צרורות", "קולות",
    "קירות", "קצוות", "קרבות", "קרונות", "רגשות", "רחובות", "ריאיונות", "רעיונות", "רצונות", "שבועות",
    "שדות", "שולחנות", "שופרות", "שטרות", "שיטפונות", "שמות",
})
# the older rewriter lacks this one
MASCULINE_PLURALS_OLDER = MASCULINE_PLURALS - {"כסאות"}

# punctuation after a word and what it becomes
CLOSING_MARKS = {
    ".": ".", "..": ".", "...": ".", ",": ",", ";": ",", ":": ",",
    "?": "?", "?!": "?", "!?": "?", "??": "?", "!": "!", "!!": "!",
    "!!!": "!", "…": ".",
}

# characters deleted, turned to a blank, and turned to "-", a double quote and an apostrophe
DELETED = "\x01\x07\u200a\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e"
BLANKS = "\t\n"
HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2015\u05be"
QUOTES = "\u00ab\u00bb\u201c\u201d\u201e\u201f\u05f4"
APOSTROPHES = "\u2018\u2019\u201b\u05f3"
# first and last code points of the emoji blocks that are removed
EMOJI = (
    (0x1F300, 0x1F5FF), (0x1F600, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F700, 0x1F77F), (0x1F780, 0x1F7FF),
    (0x1F800, 0x1F8FF), (0x1F900, 0x1F9FF), (0x1FA00, 0x1FAFF), (0x2700, 0x27BF), (0x2600, 0x26FF),
)
# white space as the rewriters see it
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# wrappers dropped from the ends of a word
OPENERS, CLOSERS = '"([{', '")]}'
# ends of a following word that do not count for its gender
TRAILING = frozenset('.,:;!?"…)]}')
TRAILING_OLDER = frozenset('.,:;!?"…')
# marks that the older rewriter drops before and after a word, in the order in which they are tried
LEADING_MARKS_OLDER = ("...", "..", '"', "'", "(", "[", ",", ".", ":", ";", "?", "!", "…")
CLOSING_MARKS_OLDER = ("...", "!!!", "..", "??", "?!", "!?", "!!", '"', ".", ",", ":", ";", "?", "!", ")", "]", "…")
# what the older rewriter makes of them; the rest become nothing
CLOSING_WORDS_OLDER = {".": ".", "..": ".", ",": ",", ";": ",", ":": ",", "?": "?", "?!": "?", "!?": "?", "??": "?", "!": "!", "!!": "!", "!!!": "!", "…": "."}
