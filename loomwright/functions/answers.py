"""Texts of reviewers and models as records, in Columns: suggested changes by clauses, and JSON answers of several shapes.

Nulls and texts that don't parse have a defined result: no clauses, or an ``error``. Everything is expressions of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("claim", "subject", "condition", "scope")
#: Wordings of suggestions (fixed values): what is done with the quoted words after each.
ACTIONS = {"改为": "replace", "写作": "replace", "改成": "replace", "补": "append"}
LAST_SENTENCE, NO_CHANGE = "末句", ("无需改", "不用改", "不需改")
#: A clause: what it is about, its wording, and the words in 「」, which may hold one more pair.
CLAUSE = f"([^，。；「」]*?)({'|'.join(ACTIONS)})[^「」]*「((?:[^「」]|「[^「」]*」)*)」"
NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def clauses(suggestion: Column) -> Column:
    """The clauses of a suggestion as an array of (field, action, value); of a clause's fields the first by ``FIELDS``, null for none."""

    def one(text: Column) -> Column:
        about, wording = F.regexp_extract(text, CLAUSE, 1), F.regexp_extract(text, CLAUSE, 2)
        last = F.contains(about, F.lit(LAST_SENTENCE))
        field = F.when(last, F.lit("claim"))
        for name in FIELDS:
            field = field.when(F.contains(about, F.lit(name)), F.lit(name))
        action = F.when(last, F.lit("last"))
        for word, meaning in ACTIONS.items():
            action = action.when(wording == word, F.lit(meaning))
        return F.struct(field.alias("field"), action.alias("action"), F.regexp_extract(text, CLAUSE, 3).alias("value"))

    return F.transform(F.regexp_extract_all(F.coalesce(suggestion, F.lit("")), F.lit(CLAUSE), F.lit(0)), one)


def _named(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it: the variable of a function over one item. Columns that are
    spelled out are evaluated wherever they stand."""
    return F.element_at(F.transform(F.array(value), body), 1)


def suggested(suggestion: Column, old: dict[str, Column]) -> Column:
    """A suggestion's new values by field (null: unchanged), how the claim came about (``mode``), and numbers in new values that the
    old record doesn't hold. Of several clauses for a field the last one counts; a suggestion of ten characters or more without
    any clause, and without words that ask for no change, is a claim as a whole."""
    before = F.concat_ws(" ", *[old[f] for f in FIELDS if f in old])
    old_claim = F.coalesce(old["claim"], F.lit(""))

    def of_text(text: Column) -> Column:
        return _named(clauses(text), lambda all_of: of_clauses(text, all_of))

    def of_clauses(text: Column, all_of: Column) -> Column:
        about = lambda f: F.filter(all_of, lambda c: (c["field"] == f) & (c["value"] != ""))
        keeps = F.exists(F.array(*map(F.lit, NO_CHANGE)), lambda w: F.contains(text, w))
        whole = (F.size(F.filter(all_of, lambda c: c["field"].isNotNull())) == 0) & (F.length(F.trim(text)) >= 10) & ~keeps
        last = F.struct(*[F.try_element_at(about(f), F.lit(-1)).alias(f) for f in FIELDS], F.when(whole, F.trim(text)).alias("whole"))
        return _named(last, of_last)

    def of_last(last: Column) -> Column:
        value, action, whole = last["claim"]["value"], last["claim"]["action"], last["whole"]
        ended = F.when(value.endswith("。"), value).otherwise(F.concat(value, F.lit("。")))
        claim = (
            F.when(action == "append", F.concat(old_claim, value)).when(action == "last", F.concat(F.regexp_extract(old_claim, "^[^。？！；]*", 0), F.lit("。"), ended))
            .when(action == "replace", value).otherwise(whole)
        )
        others = [last[f]["value"].alias(f) for f in FIELDS if f != "claim"]
        mode = F.when(action.isNotNull(), action).when(whole.isNotNull(), "whole").when(F.coalesce(claim, *others).isNotNull(), "fields").otherwise("none")
        return _named(F.struct(claim.alias("claim"), *others, mode.alias("mode")), of_values)

    def of_values(new: Column) -> Column:
        numbers = F.array_sort(F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", *[new[f] for f in FIELDS]), F.lit(NUMBER), F.lit(0))))
        held = _named(before, lambda held: F.filter(numbers, lambda n: ~F.contains(held, n)))
        return F.struct(*[new[f].alias(f) for f in FIELDS], new["mode"].alias("mode"), held.alias("new_numbers"))

    return _named(suggestion, of_text)


KINDS, SCOPES, GRADES = ("mechanism", "experiment", "reject", "pending"), ("universal", "instance", "example"), ("high", "mid", "low")


def _text(value: Column, path: str) -> Column:
    """A string at a path of a variant; null for anything that is no string."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(value, path, "string"))


def answer(text: Column) -> Column:
    """A model's answer in one shape: title, kind, confidence, scope, rules as texts, and ``error`` where it is unusable (all else is
    null then). A rule is a string or an object with a text and perhaps a scope; a kind or scope that is missing, or none of the
    known ones, follows from the rules' scopes by the first line of its table that holds."""
    v = F.try_parse_json(text)
    rules = F.try_variant_get(v, "$.rules", "array<variant>")
    stated = _text(v, "$.scope")
    shaped = F.transform(
        F.coalesce(rules, F.array().cast("array<variant>")),
        lambda r: F.struct(F.btrim(F.coalesce(_text(r, "$"), _text(r, "$.text")), F.lit(" \t\n\r")).alias("text"), F.coalesce(_text(r, "$.scope"), stated).alias("scope")),
    )
    shaped = F.filter(shaped, lambda r: r["text"] != "")
    seen = F.transform(shaped, lambda r: r["scope"])
    has = lambda s: F.coalesce(F.array_contains(seen, s), F.lit(False))
    scope = F.when(stated.isin(*SCOPES), stated).when(has("example"), "example").when(has("instance"), "instance").otherwise("universal")
    kind = _text(v, "$.kind")
    kind = F.when(kind.isin(*KINDS), kind).when(F.size(shaped) == 0, "reject").when(stated.isin("instance", "example"), "experiment").otherwise("mechanism")
    sure = _text(v, "$.confidence")
    title = _text(v, "$.title")
    given = F.try_variant_get(v, "$.rules", "variant")
    listed = given.isNull() | F.is_variant_null(given) | F.schema_of_variant(given).startswith("ARRAY")
    error = F.when(v.isNull(), "not json").when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object").when(F.coalesce(title, F.lit("")) == "", "no title").when(~listed, "rules are no list")
    fine = lambda c: F.when(error.isNull(), c)
    texts = F.transform(shaped, lambda r: r["text"])
    return F.struct(
        fine(title).alias("title"), fine(kind).alias("kind"), fine(F.when(sure.isin(*GRADES), sure).otherwise("low")).alias("confidence"),
        fine(scope).alias("scope"), fine(texts).alias("rules"), error.alias("error"),
    )


#: Digits and units of Chinese numerals (fixed values).
DIGITS, UNITS = "零一二三四五六七八九", {"十": 10, "百": 100, "千": 1000}


def written_numeral(n: Column) -> Column:
    """A number below a hundred million as a Chinese numeral; null for others."""
    names = F.array(*map(F.lit, DIGITS))

    def group(x: Column) -> Column:
        """Four places; what is missing between and before is one 零."""
        places = [(F.floor(x / value) % 10, unit) for value, unit in ((1000, "千"), (100, "百"), (10, "十"), (1, ""))]
        shown = F.concat(*[F.when(d > 0, F.concat(F.element_at(names, d.cast("int") + 1), F.lit(unit))).otherwise("零") for d, unit in places])
        return F.rtrim(F.regexp_replace(shown, "零+", "零"), F.lit("零"))

    whole = F.concat(F.when(n >= 10_000, F.concat(group(F.floor(n / 10_000)), F.lit("万"))).otherwise(""), group(n % 10_000))
    return F.when(n == 0, "零").when((n > 0) & (n < 100_000_000), F.regexp_replace(F.ltrim(whole, F.lit("零")), "^一十", "十"))


def numeral_value(text: Column) -> Column:
    """A Chinese numeral below a hundred million, or ASCII digits, as a number; null for anything else. A fold over the characters."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("part"), F.lit(-1).cast("long").alias("digit"))
    value = F.create_map(*[F.lit(x) for pair in [*((c, i) for i, c in enumerate(DIGITS)), ("〇", 0), ("两", 2)] for x in pair])
    unit = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])

    def step(at: Column, c: Column) -> Column:
        d, u = F.try_element_at(value, c).cast("long"), F.try_element_at(unit, c).cast("long")
        digit, held = at["digit"], F.greatest(at["digit"], F.lit(0).cast("long"))
        # A unit without a digit counts once at the beginning, and not at all after a 零.
        times = F.when(digit < 0, F.when(at["part"] == 0, 1).otherwise(0)).otherwise(digit).cast("long")
        total = F.when(c == "万", (at["total"] + at["part"] + held) * 10_000).otherwise(at["total"])
        part = F.when(c == "万", F.lit(0).cast("long")).when(u.isNotNull(), at["part"] + times * u).otherwise(at["part"])
        return F.struct(total.alias("total"), part.alias("part"), F.when(d.isNotNull(), d).otherwise(F.lit(-1).cast("long")).alias("digit"))

    folded = F.aggregate(chars, start, step, lambda at: at["total"] + at["part"] + F.greatest(at["digit"], F.lit(0).cast("long")))
    return F.when(text.rlike("^[0-9]{1,18}$"), F.try_to_number(text, F.lit("9" * 18)).cast("long")).when(text.rlike(f"^[{DIGITS}〇两十百千万]+$"), folded)


_ONE_TO_NINE, _ANY = "一二三四五六七八九", "零一二两三四五六七八九"


def _up_to_hundreds(text: Column, digits: str, alone: str) -> tuple[Column, Column]:
    """The value of a numeral of up to three places, and whether it is one. ``digits`` may stand before a unit or last."""
    pattern = f"^(?:([{digits}]){'?' if alone else ''}(百))?(?:([{digits}])?(十)([{digits}])?|([{_ANY}]))?$"
    place = F.create_map(*[F.lit(x) for pair in [*((c, i) for i, c in enumerate(DIGITS)), ("两", 2)] for x in pair])
    group = lambda k: F.regexp_extract(text, pattern, k)
    digit = lambda k, default: F.coalesce(F.try_element_at(place, group(k)), F.lit(default))
    value = F.when(group(2) != "", digit(1, 1) * 100).otherwise(0) + F.when(group(4) != "", digit(3, 1) * 10).otherwise(0) + F.coalesce(F.try_element_at(place, group(5)), digit(6, 0))
    return value, (text != "") & text.rlike(pattern)


def plain_numeral(text: Column) -> Column:
    """Up to three places, tens and units from one to nine; numbers in digits stay as they are. Null for anything else."""
    value, fits = _up_to_hundreds(F.trim(text), _ONE_TO_NINE, "")
    return F.when(F.trim(text).rlike(r"^[0-9]+(\.[0-9]+)?$"), F.trim(text)).when(fits, value.cast("string"))


def spoken_numeral(text: Column) -> Column:
    """Hundreds may lack their digit, and decimals follow 点, after a number up to thirty or a multiple of ten."""
    before, after = F.regexp_extract(text, "^([^点]*)", 1), F.regexp_extract(text, "^[^点]*点(.*)$", 1)
    value, fits = _up_to_hundreds(before, _ANY, "alone")
    fits = F.when(before == "", text != "").otherwise(fits)
    value = F.when(before == "", 0).otherwise(value)
    decimals = F.translate(F.replace(after, F.lit("两"), F.lit("二")), DIGITS, "0123456789")
    whole = fits & ~F.contains(text, F.lit("点"))
    parted = fits & F.contains(text, F.lit("点")) & after.rlike(f"^[{_ANY}]*$") & ~F.contains(before, F.lit("百")) & ((value <= 30) | (value % 10 == 0))
    return F.when(whole, value.cast("string")).when(parted, F.concat(value.cast("string"), F.lit("."), decimals))
