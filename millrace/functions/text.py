"""Text functions: column expressions where Catalyst can say it, Arrow-batched pandas functions where not."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import c
from millrace.session import release, small_batches


def scalar(f: Callable, kind: str) -> Callable[..., Column]:
    """A function of one value as one of a column, in small Arrow batches, whose memory is given back; a null comes in as None."""

    def run(values: pd.Series) -> pd.Series:
        release()
        return pd.Series([f(None if x is None or x != x else x) for x in values], dtype=object, index=values.index)

    def run_struct(values: pd.Series) -> pd.DataFrame:
        release()
        return pd.DataFrame([f(None if x is None or x != x else x) for x in values], index=values.index)

    def column(x: Column | str) -> Column:
        if (spark := SparkSession.getActiveSession()) is not None:
            small_batches(spark)
        return F.pandas_udf(run_struct if kind.startswith("struct") else run, kind)(c(x))

    return column


# normalisation


def fold(text: str | None) -> str:
    return " ".join(re.findall(r"[a-z0-9]+", unicodedata.normalize("NFKC", text or "").lower()))


normalize_text = scalar(fold, "string")  # STR-1
normalize_title = scalar(lambda t: f" {fold(t)} ", "string")  # STR-2


def normalize_ascii(text: Column | str) -> Column:
    """STR-1 without the compatibility fold, in the JVM: for texts known to be composed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c(text), F.lit(""))), r"[^a-z0-9]+", " "))


def collapse(text: Column | str) -> Column:
    """Runs of white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c(text), F.lit("")), r"\s+", " "))


def count_words(text: Column | str) -> Column:
    """STR-6: words between white space."""
    t = F.trim(F.regexp_replace(F.coalesce(c(text), F.lit("")), r"(?U)\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " "))).cast("long")


def tokenize(text: Column | str) -> Column:
    """STR-7."""
    return F.regexp_extract_all(F.lower(F.coalesce(c(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def shingles(tokens: Column | str, w: int = 5) -> Column:
    """STR-8: distinct runs of w tokens; all of them if there are fewer; none without tokens."""
    t = c(tokens)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - w, F.lit(0))), lambda i: F.concat_ws(" ", F.slice(t, i + 1, F.lit(w))))
    return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """SET-5: 0 when either set is empty."""
    both = F.size(F.array_intersect(c(a), c(b)))
    return F.when((F.size(c(a)) == 0) | (F.size(c(b)) == 0), 0.0).otherwise(both / F.size(F.array_union(c(a), c(b))))


# the cleaner: entities, HTML, NFKC, invisible characters, quotes and dashes, URLs, boilerplate, punctuation, white space

# fixed values: character tables and boilerplate phrases
QUOTES = {**dict.fromkeys(map(ord, "‘’‚‛‹›′＇"), "'"), **dict.fromkeys(map(ord, "“”„‟«»″＂〝〞"), '"')}
DASHES = dict.fromkeys(map(ord, "‐‑‒–—―−﹘﹣－"), "-")
INVISIBLE = regex.compile("[­᠎​-‏‪-‮⁠-⁤⁦-⁯﻿￹-￻]")
CONTROL = regex.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]")
STANDALONE = [
    "ADVERTISEMENT", "Advertisements?", r"Sponsored(?:\s+Content|\s+Links?)?", "Article continues below this ad", r"Continue\s+Reading", r"Read\s+More", r"Loading\.{2,}",
    r"Video\s+Player", "SUMMARY", r"Share\s+this\s+story", r"Cookie\s+Policy", r"Privacy\s+Policy", r"Terms\s+of\s+Service", r"Follow\s+us", r"Follow\s+Rappler", r"Photo\s+Credit", r"Image\s+Credit",
]
MARKERS = [r"(?:ALSO\s+|MUST\s+|SEE\s+ALSO\s+)?READ\s*:", r"READ\s+MORE\s*:", r"RELATED\s*(?:STORIES|ARTICLES|TOPICS|COVERAGE)?\s*:"]
CALLS = [r"Subscribe\b", r"Sign\s+up\b", r"Follow\s+us\b", r"Follow\s+Rappler\b", r"Click\s+here\b", r"Share\s+this\s+story\b", r"Continue\s+Reading\b", r"Read\s+More\b"]
BRACKETED = r"[\(\[]\s*(?:ALSO\s+|Also\s+|MUST\s+|Must\s+|SEE\s+ALSO\s+|See\s+[Aa]lso\s+)?(?:READ(?:\s+MORE)?|Read(?:\s+More)?|RELATED|Related)\s*:[^)\]\n]{0,400}[\)\]]"
COPYRIGHT = [
    r"(?i)This material may not be published,?\s*broadcast,?\s*rewritten(?:\s*,?\s*or\s+redistributed)?[^.\n]*\.?", r"(?i)(?:(?<=^)|(?<=[.!?]\s)|(?<=\n))[^.\n]*All rights reserved[^.\n]*\.?",
    r"(?im)^[ \t]*(?:\(c\)|\(r\)|[©®™]|TM(?=[\s&])|Copyright)[^\n]*$", r"(?i)Copyright\s*©?\s*\d{4}[^.\n]*\.?", r"[™©®]\s*&?\s*\d{0,4}",
]
PHRASES = [
    r"This is AI[- ]generated summari[sz]ation,?\s*which may have errors\.?", r"For context,?\s*always refer to the full article\.?", r"How does this make you feel\s*\?", r"\[\s*advertisement\s*\]",
    r"\badvertisement\b", r"\bcookie policy\b", r"\bprivacy policy\b", r"\bterms of service\b", r"\ball rights reserved\b\.?", r"\bphoto credit\s*:?", r"\bimage credit\s*:?", r"\bvideo player\b", r"\bloading\.{2,}", r"\bsponsored\b",
]
URL = r"(?i)\b(?:(?:https?|ftp)://|www\.)[^\s<>\"'()\[\]{}]+(?<![.,;:!?'\"])"
TAG = r"(?s)<(?:/?[A-Za-z][A-Za-z0-9:._-]*(?:\s[^<>]*)?/?|!--.*?--|!\[CDATA\[.*?\]\]|![A-Za-z][^<>]*)>"
GARBLED = r"[A-Za-z0-9][@\[\]^{}|~`][A-Za-z0-9]|k\^Am|kAm"

_any = "|".join
BOILERPLATE = [
    regex.compile(p) for p in (
        rf"(?im)^[ \t]*[\[(]?\s*(?:{_any(STANDALONE)})\s*[\])]?[ \t]*[.:!]?[ \t]*$", BRACKETED, rf"(?im)^[ \t]*[\[(]?\s*(?:{_any(MARKERS)})[^\n]*$",
        rf"(?im)(?:^|(?<=[.!?]\s))[ \t]*(?:{_any(CALLS)})[^\n]*$", *COPYRIGHT, *[f"(?i){p}" for p in PHRASES],
    )
]
_URL, _TAG, _SCRIPT = regex.compile(URL), regex.compile(TAG), regex.compile(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>")
_PUNCTUATION = [(regex.compile(p), s) for p, s in ((r"\.{3,}", "..."), (r"(?<!\.)\.\.(?!\.)", "."), (r"([,;:!?\-])\1+", r"\1"), (r"[ \t]*([,;:])[ \t]*(?=[.!?])", ""), (r"[ \t]+([,.;:!?])", r"\1"))]


def _tidy(t: str) -> str:
    t = regex.sub(r"[^\S\n]+", " ", t)
    return regex.sub(r"\n{3,}", "\n\n", "\n".join(line.strip() for line in t.split("\n"))).strip()


def decode_entities(t: str) -> str:
    """STR-24: entities that were encoded twice are decoded twice."""
    return html.unescape(html.unescape(t)) if "&" in t else t


def strip_html(t: str) -> str:
    return _TAG.sub(" ", _SCRIPT.sub(" ", t)) if "<" in t else t


def clean(text: str | None, boilerplate: bool = True) -> str | None:
    """STR-4: all rules in their order, until nothing changes, so that cleaning twice is cleaning once."""
    if text is None:
        return None
    for _ in range(4):
        t = unicodedata.normalize("NFKC", strip_html(decode_entities(text)))
        t = CONTROL.sub("", INVISIBLE.sub("", t.replace("\r\n", "\n").replace("\r", "\n"))).translate(QUOTES).translate(DASHES)
        t = _URL.sub(" ", t)
        for rule in BOILERPLATE if boilerplate else ():
            t = rule.sub(" ", t)
        for _ in range(5):
            before = t
            for rule, by in _PUNCTUATION:
                t = rule.sub(by, t)
            t = regex.sub(r"[\(\[\{]\s*[\)\]\}]", " ", t)
            if t == before:
                break
        t = _tidy(regex.sub(r"(?m)^[ \t]*[\p{P}\p{S}]{1,4}[ \t]*$", "", t))
        if t == text:
            return t
        text = t
    return text


clean_text = scalar(clean, "string")
clean_title = scalar(lambda t: None if t is None else " ".join((clean(t, False) or "").split()), "string")  # STR-5
strip_markup = scalar(lambda t: None if t is None else _tidy(strip_html(decode_entities(t))), "string")


def is_garbled(text: Column | str, share: float = 0.05) -> Column:
    """FLT-5: signatures of shifted characters over a share of the words."""
    return F.regexp_count(F.coalesce(c(text), F.lit("")), F.lit(GARBLED)) > F.lit(share) * count_words(text)


def repair_mojibake(t: str) -> str:
    """STR-3: UTF-8 that was read as Windows-1252, if reading it anew makes it shorter and loses nothing."""
    if not regex.search(r"[ÂÃâ][\x80-\xff€‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜™š›œŸ]", t):
        return t
    try:
        fixed = t.encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return t
    return fixed if len(fixed) < len(t) and "�" not in fixed else t


def _for_model(t: str | None) -> str | None:
    if t is None:
        return None
    t = unicodedata.normalize("NFC", repair_mojibake(t)).replace(" ", " ").replace("​", "")
    return regex.sub(r"\n{3,}", "\n\n", regex.sub(r"[ \t]+", " ", t)).strip()


normalize_input = scalar(_for_model, "string")


# sentences and chunks

_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[A-Z\"'(‘“])|\n{2,}")
# fixed values: what ends a sentence in any script, what may close after it, and words whose full stop ends none
_ANY_END, _CLOSERS = ".!?。！？؟۔।॥።։", "\"'”’）)]"
ABBREVIATIONS = frozenset("mr mrs ms dr prof sr sra st vs etc inc ltd co jr no ave gov sen rep col gen capt lt sgt".split())
_ANY_SENTENCE = regex.compile(rf"(?<=[{_ANY_END}])[{regex.escape(_CLOSERS)}]*\s+")


def sentences(t: str | None) -> list[str]:
    """STR-9: English sentences: an end followed by a capital, or a blank line."""
    return [s.strip() for s in _SENTENCE.split(t or "") if s.strip()]


def sentences_any(t: str | None) -> list[str]:
    """STR-10: sentences of any language, each line by itself; an end after an abbreviation is none."""
    out: list[str] = []
    for line in (t or "").split("\n"):
        held = ""
        for part in _ANY_SENTENCE.split(line.strip()):
            if part := part.strip():
                held = f"{held} {part}" if held else part
                last = regex.search(r"\b(\w+)\.$", held)
                if not last or last[1].lower() not in ABBREVIATIONS:
                    out.append(held)
                    held = ""
        if held:
            out.append(held)
    return out


split_sentences, split_sentences_any = scalar(sentences, "array<string>"), scalar(sentences_any, "array<string>")


def passages(text: str | None, target: int = 900, overlap: int = 150, least: int = 200, most: int | None = None) -> list[dict]:
    """STR-11: chunks of whole sentences with an overlap, the first `most` if it is given; offsets point into the text; a short tail joins the chunk before."""
    text = text or ""
    if not text.strip():
        return []
    if len(text) <= target:
        return [{"start": 0, "end": len(text), "text": text}]
    at, spans = 0, []
    for s in sentences(text):
        i = max(text.find(s, at), at)
        spans.append((i, i + len(s)))
        at = i + len(s)
    out: list[list[int]] = []
    start = end = spans[0][0]
    for a, b in spans:
        if b - start > target and end > start:
            out.append([start, end])
            if most is not None and len(out) >= most:
                break
            start = max(end - overlap, a - overlap, 0, out[-1][0] + 1)
        end = b
    else:
        if out and end - start < least:
            out[-1][1] = end
        elif end > start:
            out.append([start, end])
    return [{"start": a, "end": b, "text": text[a:b]} for a, b in out[:most]]


def chunk_text(text: Column | str, target: int = 900, overlap: int = 150, least: int = 200, most: int | None = None) -> Column:
    return scalar(lambda t: passages(t, target, overlap, least, most), "array<struct<start:int,end:int,text:string>>")(text)


def hard_split(unit: str, most: int, count: Callable[[str], int]) -> list[str]:
    """A unit over the budget, cut at blanks, or by the share of characters where it has none."""
    if count(unit) <= most:
        return [unit]
    words, out, here = unit.split(" "), [], ""
    if len(words) == 1:
        step = max(1, len(unit) * most // count(unit))
        return [unit[i : i + step] for i in range(0, len(unit), step)]
    for w in words:
        joined = f"{here} {w}" if here else w
        if here and count(joined) > most:
            out.append(here)
            joined = w
        here = joined
    return [p for x in [*out, here] if x for p in (hard_split(x, most, count) if " " not in x else [x])]


def pack(text: str | None, target: int = 64, most: int = 192, count: Callable[[str], int] = lambda s: len(s.split())) -> list[str]:
    """STR-12: sentences packed up to the target; one over the limit is flushed and cut."""
    out, here = [], ""
    for s in sentences_any(text):
        if count(s) > most:
            out += [here] if here else []
            here = ""
            out += hard_split(s, most, count)
        elif here and count(f"{here} {s}") > target:
            out.append(here)
            here = s
        else:
            here = f"{here} {s}" if here else s
    return out + ([here] if here else [])


pack_chunks = scalar(pack, "array<string>")


# scripts and languages

# fixed values: scripts with the code of the language they stand for by default
SCRIPTS = [
    ("Hiragana", "jpn_Jpan"), ("Katakana", "jpn_Jpan"), ("Hangul", "kor_Hang"), ("Han", "zho_Hans"), ("Arabic", "arb_Arab"), ("Cyrillic", "rus_Cyrl"), ("Devanagari", "hin_Deva"), ("Bengali", "ben_Beng"),
    ("Thai", "tha_Thai"), ("Greek", "ell_Grek"), ("Hebrew", "heb_Hebr"), ("Tamil", "tam_Taml"), ("Telugu", "tel_Telu"), ("Gujarati", "guj_Gujr"), ("Gurmukhi", "pan_Guru"), ("Kannada", "kan_Knda"),
    ("Malayalam", "mal_Mlym"), ("Sinhala", "sin_Sinh"), ("Myanmar", "mya_Mymr"), ("Khmer", "khm_Khmr"), ("Lao", "lao_Laoo"), ("Georgian", "kat_Geor"), ("Armenian", "hye_Armn"), ("Ethiopic", "amh_Ethi"), ("Latin", None),
]
FLORES = {
    "en": "eng_Latn", "fr": "fra_Latn", "de": "deu_Latn", "es": "spa_Latn", "pt": "por_Latn", "it": "ita_Latn", "nl": "nld_Latn", "sv": "swe_Latn", "no": "nob_Latn", "da": "dan_Latn", "fi": "fin_Latn", "pl": "pol_Latn",
    "cs": "ces_Latn", "sk": "slk_Latn", "hu": "hun_Latn", "ro": "ron_Latn", "hr": "hrv_Latn", "sl": "slv_Latn", "tr": "tur_Latn", "id": "ind_Latn", "ms": "zsm_Latn", "vi": "vie_Latn", "tl": "tgl_Latn", "sw": "swh_Latn",
    "ru": "rus_Cyrl", "uk": "ukr_Cyrl", "bg": "bul_Cyrl", "sr": "srp_Cyrl", "mk": "mkd_Cyrl", "el": "ell_Grek", "ar": "arb_Arab", "fa": "pes_Arab", "ur": "urd_Arab", "he": "heb_Hebr", "hi": "hin_Deva", "mr": "mar_Deva",
    "ne": "npi_Deva", "bn": "ben_Beng", "ta": "tam_Taml", "te": "tel_Telu", "gu": "guj_Gujr", "kn": "kan_Knda", "ml": "mal_Mlym", "pa": "pan_Guru", "th": "tha_Thai", "my": "mya_Mymr", "km": "khm_Khmr", "lo": "lao_Laoo",
    "ja": "jpn_Jpan", "ko": "kor_Hang", "zh": "zho_Hans", "zh-cn": "zho_Hans", "zh-tw": "zho_Hant", "ka": "kat_Geor", "hy": "hye_Armn", "am": "amh_Ethi",
}
_SCRIPT_OF = [(n, code, regex.compile(rf"\p{{Script={n}}}")) for n, code in SCRIPTS]


def dominant_script(t: str | None, sample: int | None = None) -> str | None:
    """STR-13: the script of most letters, of the first `sample` characters if it is given; any kana makes a text Japanese."""
    t = (t or "")[:sample]
    n = {name: len(p.findall(t)) for name, _, p in _SCRIPT_OF}
    if n["Hiragana"] or n["Katakana"]:
        return "Hiragana"
    best = max(n, key=n.get)
    return best if n[best] else None


detect_script = scalar(lambda t: dominant_script(t), "string")


def to_flores(code: Column | str, text: Column | str | None = None, table: dict[str, str] = FLORES) -> Column:
    """STR-14: the code of a language (its region dropped if need be), else that of the text's script."""
    k = F.lower(F.regexp_replace(F.trim(c(code)), "_", "-"))
    t = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    known = F.coalesce(F.try_element_at(t, k), F.try_element_at(t, F.regexp_extract(k, "^[a-z]+", 0)))
    if text is None:
        return known
    by_script = F.create_map(*[F.lit(x) for n, code in SCRIPTS if code for x in (n, code)])
    return F.coalesce(known, F.try_element_at(by_script, detect_script(text)))


STOPWORDS = {
    "en": "the of and to in is that for it was on with as are be by this from at", "fr": "le la les de des et un une en est que pour dans sur du qui au pas",
    "de": "der die das und ist in den von zu mit dem für auf ein eine nicht als", "es": "el la los de y que en un una por con para las del se es al no",
    "pt": "o a os as de do da dos das e que em no na um uma para com não por se ao", "it": "il lo la gli le di del della e che in un una per con non è si da al sono",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als bij", "sv": "och i att det som en på är av för med den till inte om ett har de från var",
    "da": "og i at det som en på er af for med den til ikke om et har de fra var", "pl": "i w na z do że nie się jest to o jak po przez od za dla są ale który",
    "tr": "ve bir bu da de için ile çok olarak olan gibi daha kadar ne en sonra ama olduğu", "id": "yang dan di dari untuk dengan ini itu pada tidak akan ada ke dalam oleh juga sebagai",
    "ro": "și în de la cu o un pe nu din este ce să pentru care mai au fost sunt prin", "hu": "a az és hogy nem is egy ez volt meg van ki de csak már még vagy mint",
    "fi": "ja on ei se että oli hän mutta ovat kuin myös tai jos joka sen ole kun niin", "vi": "và của là có trong được cho không các với người này những một đã khi từ",
}


def guess_language(t: str | None, least: int = 20, sample: int | None = None) -> str | None:
    """STR-15's fallback: the language with most stop words, in the first `sample` characters if it is given."""
    if not t or len(t.strip()) < least:
        return None
    words = re.findall(r"\w+", t[:sample].lower())
    n = {k: sum(w in s for w in words) for k, s in ((k, set(s.split())) for k, s in STOPWORDS.items())}
    best = max(sorted(n), key=n.get)
    return best if n[best] else None


def detect_language(text: Column | str, declared: Column | str | None = None) -> Column:
    """STR-15: the declared language if there is one, else a guess from the text."""
    guess = scalar(lambda t: guess_language(t), "string")(text)
    return F.coalesce(F.nullif(F.lower(F.trim(c(declared))), F.lit("")), guess) if declared is not None else guess


# surface forms of numbers

# fixed values: number words and multipliers
WORDS = dict(zip("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety".split(), [*range(21), 30, 40, 50, 60, 70, 80, 90], strict=True))
MULTIPLIERS = {"hundred": 100, "thousand": 1000, "lakh": 100_000, "lakhs": 100_000, "crore": 10_000_000, "crores": 10_000_000, "million": 1_000_000, "billion": 1_000_000_000}


def number_forms(value: float | None) -> list[str]:
    """NUM-3: digits, separators, Indian grouping, scaled words and the word itself."""
    if value is None:
        return []
    if value != int(value):
        return [f"{value:g}"]
    n = int(value)
    out = [str(n)]
    if n >= 1000:
        head, tail = str(n)[:-3], str(n)[-3:]
        pairs = re.findall(r"\d{1,2}", head[::-1])
        out += [f"{n:,}", f"{n:,}".replace(",", " "), ",".join([*(p[::-1] for p in reversed(pairs)), tail])]
    out += [f"{n // m} {w}" for w, m in MULTIPLIERS.items() if n >= m and n % m == 0]
    out += [w for w, x in (WORDS | MULTIPLIERS).items() if x == n]
    return list(dict.fromkeys(out))


number_surface_forms = scalar(number_forms, "array<string>")
