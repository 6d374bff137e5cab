"""Text functions of the feed: columns in, columns out, all inside the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial, reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslens.functions import words as W

CYRILLIC = r"[Ѐ-ӿ]"
LATIN = r"[A-Za-z]"


def count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text holds one of some literals; null counts as empty."""
    return bound(F.coalesce(text, F.lit("")), lambda t: reduce(or_, [F.contains(t, F.lit(p)) for p in parts]))


def detect_language(text: Column) -> Column:
    """By share of all characters: Cyrillic over 0.2 ru, Arabic over 0.2 ar, Latin over 0.3 en, else other; empty unknown."""
    n = F.length(text)
    return (
        F.when(text.isNull() | (n == 0), "unknown")
        .when(count(text, CYRILLIC) * 5 > n, "ru")
        .when(count(text, r"[؀-ۿ]") * 5 > n, "ar")
        .when(count(text, LATIN) * 10 > n * 3, "en")
        .otherwise("other")
    )


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\r\n]+"), lambda w: w != "")


def first_tokens(text: Column, n: int, head: int = 512) -> Column:
    """The first ``n`` of ``tokens``: of the text's start if that has more of them (the last may be cut), else of the whole text."""
    begun = tokens(F.substring(text, 1, head))
    return F.when(F.size(begun) > n, F.slice(begun, 1, n)).otherwise(F.slice(tokens(text), 1, n))


def _bare(word: Column) -> Column:
    return F.regexp_replace(word, r"[^\p{L}\p{N}_-]", "")


def title_words(title: Column) -> Column:
    """Distinct lower-case words of more than three letters that aren't stop words."""
    bare = F.transform(tokens(title), lambda w: F.lower(_bare(w)))
    return F.array_distinct(F.filter(bare, lambda w: (F.length(w) > 3) & ~w.isin(*W.STOP)))


def proper_nouns(title: Column) -> Column:
    """Distinct capitalised words of at least three letters."""
    return F.array_distinct(F.filter(F.transform(tokens(title), _bare), lambda w: (F.length(w) > 2) & w.rlike(r"^\p{Lu}\p{L}+$")))


def signature(title: Column) -> Column:
    """Latin words and numbers that both languages of a bilingual publisher share; null if there are fewer than two."""
    latin = F.regexp_extract_all(F.lower(title), F.lit(r"([a-z]{3,})"), F.lit(1))
    numbers = F.regexp_extract_all(title, F.lit(r"([0-9]{2,4})"), F.lit(1))
    both = F.array_sort(F.array_distinct(F.concat(latin, numbers)))
    return F.when(F.size(both) >= 2, F.array_join(both, " "))


def stems(text: Column, least: int, size: int) -> Column:
    """Distinct starts of the words of at least ``least`` letters."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"([а-яёa-zà-ú]{{{least},}})"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda w: F.substring(w, 1, size)))


def overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """Shared members and the size of the smaller set: the similarity used everywhere is their ratio."""
    return F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))


def cache_key(url: Column, title: Column) -> Column:
    key = F.when(F.length(url) > 0, url).otherwise(F.coalesce(title, F.lit("")))
    return F.right(F.translate(key, "./#$[]", "______"), F.lit(180))


def post_keys(url: Column, title: Column) -> Column:
    """Two keys under which a post counts as seen: its address and its title's word starts."""
    address = F.concat(F.lit("u:"), F.substring(F.regexp_replace(F.coalesce(url, F.lit("")), r"[./#$\[\]]", "_"), 1, 96))
    starts = F.transform(F.filter(F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1)), lambda w: F.length(w) > 3), lambda w: F.substring(w, 1, 6))
    joined = F.array_join(F.slice(F.array_sort(F.array_distinct(starts)), 1, 10), "-")
    return F.array(address, F.concat(F.lit("t:"), F.substring(joined, 1, 96)))


def story_id(title: Column) -> Column:
    return F.substring(F.sha1(F.lower(F.trim(title)).cast("binary")), 1, 10)


def image_key(url: Column) -> Column:
    return F.substring(F.sha1(url.cast("binary")), 1, 16)


def needs_translation(language: Column, pool: Column, title: Column, body: Column) -> Column:
    """Unknown or other languages do; the ru pool reads its neighbours unless the title is Kazakh and the body isn't."""
    kazakh = r"[әғқұһӘҒҚҰҺ]"
    read = language.isin(*W.READ_BY_RU) & ~((count(title, kazakh) >= 2) & (count(body, kazakh) == 0))
    return F.when(language.isNull() | language.isin("unknown", "other"), True).when(pool == "ru", ~read).otherwise(language != pool)


def still_foreign(text: Column, pool: Column) -> Column:
    """Whether a translation is left in another language; texts of fewer than 40 characters aren't judged."""
    cyrillic = count(text, CYRILLIC)
    ru = (count(text, r"[ўқғҳөүңӯҷӣ]") >= 2) | ((cyrillic < 10) & (count(text, r"[A-Za-z]{4,}") >= 8))
    return F.when(F.length(F.coalesce(text, F.lit(""))) < 40, False).when(pool == "ru", ru).otherwise(cyrillic >= 10)


def wrong_alphabet(text: Column, pool: Column) -> Column:
    cyrillic = count(text, CYRILLIC)
    return F.when(pool == "ru", (cyrillic < 5) & (count(text, r"[A-Za-z]{2,}") >= 5)).otherwise(cyrillic >= 5)


def service_format(url: Column, title: Column) -> Column:
    return any_of(F.lower(url), W.SERVICE_URLS) | any_of(F.lower(title), W.SERVICE_TITLES)


def incident(title: Column, summary: Column) -> Column:
    return any_of(F.lower(F.concat_ws(" ", title, F.substring(summary, 1, 200))), W.INCIDENT)


def daily_filler(title: Column) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return low.rlike(W.FILLER_ALONE) | (F.substring(low, 1, 30).rlike(W.FILLER_GAME) & low.rlike(W.FILLER_SERVICE))


def ends_with(text: Column, pattern: str) -> Column:
    """Whether one character of ``pattern`` stands at the end, or before a last line break."""
    return F.right(text, F.lit(3)).rlike(f"(?s){pattern}$")


def mangled(body: Column) -> Column:
    """A body that ends in a colon or dash, or runs over twelve words without closing."""

    def judged(tail: Column) -> Column:
        words = F.filter(F.split(tail, r"[ \t\r\n]+", 14), lambda w: w != "")
        return ends_with(tail, "[:—–-]") | ((F.size(words) > 12) & ~ends_with(tail, "[.!?…»\"')]"))

    return bound(F.rtrim(F.coalesce(body, F.lit(""))), judged)


#: Service tails are looked for in so many characters at the end. No match but that of a credit in brackets, or
#: with a long run of white space, is longer than ``TAIL_MATCH``; so much must be left in front of what goes.
TAIL_WINDOW, TAIL_MATCH = 512, 200


def _without_tails(text: Column) -> Column:
    for _ in range(3):
        for pattern in W.TAILS:
            text = F.rtrim(F.regexp_replace(text, f"(?isu){pattern}", ""), F.lit(" .,—-–;:\n"))
    return text


def _tailless(text: Column) -> Column:
    """Three layers of service tails go; long texts are only read at their end, where that gives the same."""

    def judged(x: Column) -> Column:
        credit = F.contains(x["tail"], F.lit(")")) & text.rlike(r"(?iu)\(image credit:|\(фото:")
        same = (F.length(x["short"]) >= TAIL_MATCH) & ~x["tail"].rlike(r"\s{100}") & ~credit
        head = F.substring(text, F.lit(1), F.length(text) - TAIL_WINDOW)
        return F.when(same, F.concat(head, x["short"])).otherwise(_without_tails(text))

    ends = bound(F.right(text, F.lit(TAIL_WINDOW)), lambda t: F.struct(t.alias("tail"), _without_tails(t).alias("short")))
    return F.when(F.length(text) <= TAIL_WINDOW, _without_tails(text)).otherwise(bound(ends, judged))


def _up_to_last(text: Column, pattern: str, window: int = 2048) -> Column:
    """The text up to the last match of ``pattern`` (one character and what it looks ahead at), else empty: looked for at the end first."""
    greedy = f"(?s)^(.*(?:{pattern}))"
    near = lambda e: F.when(e != "", F.concat(F.substring(text, F.lit(1), F.length(text) - window), e)).otherwise(F.regexp_extract(text, greedy, 1))
    return F.when(F.length(text) <= window, F.regexp_extract(text, greedy, 1)).otherwise(bound(F.regexp_extract(F.right(text, F.lit(window)), greedy, 1), near))


def strip_tail(text: Column) -> Column:
    """Up to three layers of service tails go; a text cut short ends at its last whole sentence."""

    def last_sentence(out: Column) -> Column:
        whole = bound(_up_to_last(out, r"[.!?](?= )|\.(?=\n)|…"), lambda w: F.when(F.length(w) > 81, w).otherwise(out))
        return F.trim(F.when((out != "") & ~ends_with(out, "[.!?…»\"']"), whole).otherwise(out))

    return bound(bound(F.coalesce(text, F.lit("")), _tailless), last_sentence)


def _without_early(text: Column, *, part: str) -> Column:
    """The text without ``part`` where that starts in the first 300 characters."""
    at = F.instr(text, part)
    rest = F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + len(part), F.length(text)))
    return F.when((at > 0) & (at <= 300), F.btrim(rest, F.lit(" .,—-\n"))).otherwise(text)


def strip_boilerplate(text: Column) -> Column:
    def without(out: Column) -> Column:
        whole = out
        for part in W.BOILERPLATE:
            out = bound(out, partial(_without_early, part=part))
        early = F.substring(whole, 1, 300 + max(map(len, W.BOILERPLATE)))
        return F.when(any_of(early, W.BOILERPLATE), out).otherwise(whole)

    return strip_tail(bound(F.coalesce(text, F.lit("")), without))


def sentence_cut(text: Column, size: int = 1300) -> Column:
    """At most ``size`` characters, up to the last end of a sentence past the 150th; a word of three letters stands before such an end. Null stays null."""
    head = F.substring(text, 1, size)
    whole = F.regexp_extract(head, r"(?s)^(.*[а-яёa-z]{3,}[.!?][\s\u00a0])", 1)
    return F.when(F.length(text) <= size, text).when(F.length(whole) > 151, whole).otherwise(head)


def sentences(text: Column) -> Column:
    """Sentences without white space around them: an end follows two letters or digits, so initials don't count. Null and empty texts have none."""
    parts = F.regexp_extract_all(F.concat(F.coalesce(text, F.lit("")), F.lit(" ")), F.lit(r"(?s)(.*?(?:[а-яёa-zà-ú\d]{2,}[.!?][\s\u00a0]+|\z))"), F.lit(1))
    return F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"^[\s\u00a0]+|[\s\u00a0]+$", "")), lambda x: x != "")


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


SENTENCE_END = r"[а-яёa-zà-ú\d]{2}[.!?]"


def _without_captions(text: Column) -> Column:
    """A text's sentences with single spaces between, from the one after the last of the first three that holds a credit; without one, after a short caption at the start. A text of captions only stays.

    Only the first three are told apart; what follows them is put in order as a whole.
    """

    def joined(x: Column) -> Column:
        first, rest = x["first"], x["rest"]
        credited = F.transform(F.slice(first, 1, 3), lambda p, i: F.when(p.rlike(f"(?u){W.CREDIT}"), i + 1).otherwise(0))
        last = F.aggregate(credited, F.lit(0), lambda a, b: F.greatest(a, b))
        opening, size = F.get(first, F.lit(0)), F.size(first) + (rest != "").cast("int")
        caption = (size > 1) & (F.length(opening) < 220) & opening.rlike(f"(?u){W.CAPTION_VERBS}")
        cut = F.when(last > 0, last).when(caption, 1).otherwise(0)
        return bound(F.when(cut < size, cut).otherwise(0), lambda c: F.array_join(F.concat(F.slice(first, c + 1, F.greatest(F.size(first), F.lit(1))), F.when(rest != "", F.array(rest)).otherwise(F.array().cast("array<string>"))), " "))

    def parts(x: Column) -> Column:
        after = F.substring(x["text"], F.length(x["three"]) + 1, F.length(x["text"]))
        rest = _stripped(F.regexp_replace(after, f"({SENTENCE_END})[\\s\\u00a0]+", "$1 "))
        long = F.struct(sentences(x["three"]).alias("first"), rest.alias("rest"))
        return F.when(x["three"] != "", long).otherwise(F.struct(sentences(x["text"]).alias("first"), F.lit("").alias("rest")))

    three = r"(?s)^((?:.*?[а-яёa-zà-ú\d]{2,}[.!?][\s\u00a0]+){3})"
    split = bound(text, lambda t: F.struct(t.alias("text"), F.regexp_extract(t, three, 1).alias("three")))
    return bound(bound(split, parts), joined)


def _whole_end(text: Column) -> Column:
    """A text that breaks off ends with its last whole sentence (past the 80th character); one that only lacks its full stop gets it."""
    open_ = (text != "") & ~text.rlike("[.!?…»\"']$")
    last = F.regexp_extract(text, r"([^\s\u00a0]+)$", 1)
    hangs = (F.length(F.btrim(last, F.lit(".,"))) <= 2) | F.lower(last).isin(*W.HANGING)
    whole = F.regexp_extract(F.concat(text, F.lit(" ")), r"(?s)^(.*[а-яёa-zà-ú]{3,}[.!?])[\s\u00a0]", 1)
    return F.when(open_ & hangs & (F.length(whole) >= 80), whole).when(open_ & ~hangs, F.concat(text, F.lit("."))).otherwise(text)


def polish(text: Column) -> Column:
    """A body without date lines (up to three layers), credits, captions and teasers, that doesn't break off. Null and empty give ``''``."""
    out = _stripped(F.coalesce(text, F.lit("")))
    for _ in range(3):
        for pattern in W.DATELINES:
            out = F.regexp_replace(out, f"(?u){pattern}", "")
        out = F.btrim(out, F.lit(" —-–·|"))
    out = _without_captions(F.regexp_replace(out, f"(?u){W.CHART_LINE}", ""))
    out = _stripped(F.regexp_replace(out, r"[\s\u00a0]{2,}", " "))
    out = _stripped(F.regexp_replace(out, f"(?u){W.TEASERS}", ""))
    return _stripped(bound(out, _whole_end))


def title_tail(title: Column) -> Column:
    """The title without its source's name, where at least 25 characters stay."""
    short = F.trim(F.regexp_replace(title, W.TITLE_TAIL, ""))
    return F.when(F.length(short) >= 25, short).otherwise(title)


_NAMED = json.dumps({name: chr(code) for name, code in (name2codepoint | {"apos": 39}).items()})


def unescape(text: Column) -> Column:
    """Named (of HTML 4) and numeric entities as characters, each once: what an ampersand's entity gives isn't read again.

    Numbers that are no character become U+FFFD; unknown names stay.
    """
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,15};))"), F.lit(1)))
    names = F.from_json(F.lit(_NAMED), "map<string,string>")

    def char(entity: Column) -> Column:
        inner = F.regexp_replace(entity, "^&|;$", "")
        digits = F.when(inner.rlike("^#[xX]"), F.conv(F.substring(inner, 3, 8), 16, 10)).otherwise(F.substring(inner, 2, 8)).cast("long")
        code = F.when((digits == 0) | digits.between(0xD800, 0xDFFF) | (digits > 0x10FFFF), 0xFFFD).otherwise(digits)
        return F.when(F.startswith(inner, F.lit("#")), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.try_element_at(names, inner))

    # Longer ones first, as one may begin another; those that give an ampersand last.
    each = F.transform(found, lambda e: F.struct((char(e) == "&").alias("last"), (-F.length(e)).alias("size"), e.alias("entity"), char(e).alias("char")))
    known = F.array_sort(F.filter(each, lambda e: e["char"].isNotNull()))
    out = F.aggregate(known, text, lambda t, e: F.replace(t, e["entity"], e["char"]))
    return F.when(F.contains(text, F.lit("&")), out).otherwise(text)


def clean_text(text: Column) -> Column:
    """Text without entities, zero-width spaces, tags, left-over attributes, stray closing brackets and runs of white space."""
    out = bound(F.coalesce(text, F.lit("")), unescape)
    out = F.regexp_replace(F.replace(out, F.lit("\u200b"), F.lit("")), "\u00a0", " ")
    out = F.regexp_replace(out, r"<[a-zA-Z/!][^<>\"]*+(?:\"[^\"]*\"[^<>\"]*+)*+>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    out = F.regexp_replace(out, W.ORPHAN_ATTRIBUTES, "$1 ")
    out = F.regexp_replace(out, r"\s*/?>\s*", " ")
    return F.btrim(F.regexp_replace(out, r"\s+", " "))


def shorten(title: Column, size: int = 52) -> Column:
    return F.when(F.length(title) <= size, title).otherwise(F.concat(F.regexp_replace(F.substring(title, 1, size), r" [^ ]*$", ""), F.lit("…")))


def view_count(n: Column) -> Column:
    return F.when(n >= 1_000_000, F.concat(F.format_number(n / 1e6, 1), F.lit("M"))).when(n >= 1000, F.concat((n / 1000).cast("long").cast("string"), F.lit("K"))).otherwise(n.cast("string"))


def pub_date(text: Column) -> Column:
    """Epoch milliseconds of an RFC-822 date, null where it can't be read."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), "^[A-Za-z]{3}, *", ""), "(GMT|UTC|Z)$", "+0000")
    return F.unix_millis(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")))


def plain_score(priority: Column, published: Column, as_of_ms: int, image: Column, summary: Column, title: Column) -> Column:
    age = (F.lit(as_of_ms) - published) / 3_600_000.0
    photo = F.when(F.length(image) > 0, 25.0).otherwise(0.0)
    return priority * 100 + F.greatest(F.lit(0.0), 48 - age) + photo + F.least(F.length(F.coalesce(summary, F.lit(""))) / 40.0, F.lit(25.0)) - F.when(F.length(title) < 25, 20.0).otherwise(0.0)
