r"""Personal data by proposed, confirmed and scored spans (list item 5, DataFrame functions only).

Regular expressions propose leftmost non-overlapping spans of each kind; a
validator confirms them (number ranges, digit counts, the Luhn checksum, the
mod-97 checksum of account numbers); whole words within ``CONTEXT_CHARS``
signs before or after the span raise its score.
``regexp_extract_all`` gives the matches and ``split`` by the same pattern the
text between them, so running lengths give code-point offsets without Python.

The patterns are the plain ones of ``KINDS`` written so that Java's matcher
neither recurses nor rescans: repeated groups are possessive (nothing follows
them that could need a shorter match) and a run of characters is entered only
at its start or where the previous match ended (every start inside the run
would meet the same end), so time is linear and the stack flat on texts of
any length.

Edge cases: a null or empty text has no spans; overlapping spans of
different kinds are all reported; rows are independent, so ties, repeated
rows and hot sources need nothing; an empty table gives no rows; input
columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_others, quoted

# kind -> (trigger, pattern, validator over m, base score, context words)
KINDS: dict[str, tuple[str, str, str, float, str]] = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
              "true", 0.8, "e-?mails?|mail|contact|write|address|kontakt|correo|courriel"),
    "ip": (r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
           "forall(split(m, '[.]'), p -> cast(concat('0', left(trim(LEADING '0' FROM p), 4)) as int) <= 255)",
           0.5, "servers?|hosts?|address|login|ip"),
    "card": ("[0-9][ -]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++",
             "exists(array(regexp_replace(m, '[ -]', '')), d -> if(length(d) between 13 and 19, {luhn}, false))",
             0.7, "cards?|visa|credit|(?:kredit)?karte|carte|tarjeta|payment"),
    "phone": (r"[+][0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
              "length(regexp_replace(m, '[^0-9]', '')) between 9 and 15", 0.5, "(?:tele)?phone|call|tel|fax|mobile|anruf|telefon[oe]?"),
    "iban": ("[A-Z]{2}[0-9]{2}",
             r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
             "exists(array(concat(substr(replace(m, ' ', ''), 5), left(replace(m, ' ', ''), 4))), "
             "d -> if(length(d) between 15 and 34, {mod97}, false))", 0.8, "iban|account|konto|bank|cuenta|compte"),
}
BASE_KINDS = ("email", "ip", "card", "phone")
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.2

# over d, the digits: every second digit from the right is doubled, its own digits summed
_LUHN = ("aggregate(sequence(1, length(d)), 0L, (s, i) -> cast(s + (cast(substr(d, -i, 1) as int) * (2 - i % 2)) div 10 "
         "+ (cast(substr(d, -i, 1) as int) * (2 - i % 2)) % 10 as bigint), s -> s % 10 = 0)")
# over d, the number with its first four signs moved to the end: letters count 10 to 35
_MOD97 = ("aggregate(sequence(1, length(d)), 0L, (s, i) -> cast(if(substr(d, i, 1) between '0' and '9', "
          "s * 10 + ascii(substr(d, i, 1)) - 48, s * 100 + ascii(substr(d, i, 1)) - 55) % 97 as bigint), s -> s = 1)")
SPAN = "struct<kind:string,start:bigint,end:bigint,text:string,score:double>"


def _spans_sql(kind: str) -> str:
    """SQL text over column __text: array<SPAN> of the confirmed spans of one kind, by start."""
    trigger, pattern, valid, base, words = KINDS[kind]
    valid = valid.replace("{luhn}", _LUHN).replace("{mod97}", _MOD97)
    none = f"cast(array() as array<{SPAN}>)"
    hit = f"instr(__text, '{trigger}') > 0" if len(trigger) == 1 else f"rlike(__text, r'{trigger}')"
    start = "a.at + length(x.p)"
    # the window goes on over the matches beside the span; a blank stands for the span itself
    around = f"lower(concat(right(concat(a.tail, x.p), {CONTEXT_CHARS}), ' ', left(concat(x.p2, coalesce(x.m2, ''), x.p3), {CONTEXT_CHARS})))"
    score = f"least(1.0D, {base}D + if(rlike({around}, r'(?<![\\p{{L}}])(?:{words})(?![\\p{{L}}])'), {CONTEXT_BONUS}D, 0.0D))"
    span = (f"named_struct('kind', '{kind}', 'start', cast({start} as bigint), "
            f"'end', cast({start} + length(x.m) as bigint), 'text', x.m, 'score', {score})")
    # the piece after the last match has no match; p2, m2, p3: what follows a match
    zipped = ("zip_with(zip_with(s.p, s.m, (p, m) -> named_struct('p', p, 'm', m)), "
              "zip_with(slice(s.p, 2, size(s.p)), zip_with(slice(s.m, 2, size(s.m)), slice(s.p, 3, size(s.p)), "
              "(m, p) -> named_struct('m', m, 'p', p)), (p, n) -> named_struct('p', p, 'n', n)), "
              "(x, n) -> named_struct('p', x.p, 'm', x.m, 'p2', coalesce(n.p, ''), 'm2', n.n.m, 'p3', coalesce(n.n.p, '')))")
    pairs = f"filter({zipped}, x -> x.m is not null)"
    cut = f"named_struct('p', split(__text, r'{pattern}', -1), 'm', regexp_extract_all(__text, r'{pattern}', 0))"
    walked = (f"aggregate(flatten(transform(array({cut}), s -> {pairs})), named_struct('at', 0L, 'tail', '', 'out', {none}), "
              f"(a, x) -> named_struct('at', cast(a.at + length(x.p) + length(x.m) as bigint), "
              f"'tail', right(concat(a.tail, x.p, x.m), {CONTEXT_CHARS}), "
              f"'out', if(exists(array(x.m), m -> {valid}), concat(a.out, cast(array({span}) as array<{SPAN}>)), a.out)), a -> a.out)")
    return f"if({hit}, {walked}, {none})"


def find_pii(docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = tuple(KINDS),
             min_score: float = 0.0) -> DataFrame:
    """All columns of ``docs`` plus spans: array<SPAN> by kind as listed, then start, of min_score at least."""
    cols = keep_others(docs, ["spans", "__text"])
    texts = docs.select(*[quoted(c) for c in cols],
                        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("__text"))
    spans = F.expr("concat(" + ", ".join(_spans_sql(k) for k in kinds) + ")")
    if min_score > 0:
        spans = F.filter(spans, lambda s: s["score"] >= min_score)
    return texts.select(*[quoted(c) for c in cols], spans.alias("spans"))
