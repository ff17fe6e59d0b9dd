"""Words of a text as array expressions: no Python per row and no shuffle.

A text is cut like a treebank tokenizer does (punctuation apart, clitics apart, hyphenated
and dotted words whole) and only tokens of letters and digits stay. Sentences are not
detected by a trained model: a period before white space ends a sentence, so that the word
before it counts, also if it is an abbreviation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and punctuation which always stands apart.
SEPARATORS = "[ \\t\\n\\r\\f\\x0b\\x1c-\\x1f\\x85\\p{Z};@#$%&?!\\[\\](){}<>\"“”„«»‘’`|…]+"
LETTERS_AND_DIGITS = "^[\\p{L}\\p{N}]+$"

# What else is cut inside a chunk between separators, applied in this order; $1 is the first
# group. The patterns use only what every common regular expression dialect understands.
CUTS = (
    ("[:,]+([^0-9:,])", " $1"),
    ("([:,]+|[.][.]+|--+)$", " "),
    ("[.][.]+|--+", " "),
    ("[.]( |$)", " "),
    ("([nN]'[tT]|'(s|S|m|M|d|D|ll|LL|re|RE|ve|VE)?)( |$)", " "),
    ("(^| )'", " "),
    ("(^| )([cC]an)(not)( |$)", " $2 $3 "),
    ("(^| )([gG]on|[wW]an)(na)( |$)", " $2 $3 "),
    ("(^| )([gG]ot)(ta)( |$)", " $2 $3 "),
    ("(^| )([gG]im|[lL]em)(me)( |$)", " $2 $3 "),
)

# Words written together which count as two.
JOINED = (
    "cannot", "Cannot", "gonna", "Gonna", "wanna", "Wanna", "gotta", "Gotta",
    "gimme", "Gimme", "lemme", "Lemme",
)

# English stop words.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them
    their theirs themselves what which who whom this that that'll these those am is are was
    were be been being have has had having do does did doing a an the and but if or because
    as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
    haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Words which mark a post as a thank-you.
THANKS = ("thank", "thx")

# Verb endings and what replaces them.
VERB_ENDINGS = (
    ("s", ""),
    ("ies", "y"),
    ("es", "e"),
    ("es", ""),
    ("ed", "e"),
    ("ed", ""),
    ("ing", "e"),
    ("ing", ""),
)

# A small verb lexicon; callers with a larger one pass it instead.
VERBS = tuple(
    """
    accept add agree allow answer appear apply appreciate arrive ask become begin believe
    break bring build buy call carry change choose close come consider continue cost create
    decide describe develop discuss draw drive drop eat end enjoy expect explain fall feel
    find finish follow forget get give go grow happen hate hear help hold hope imagine
    improve include join jump keep kill know laugh learn leave let like listen live look lose
    love make manage mean meet miss move need offer open order pass pay pick plan play post
    prefer prepare prevent produce promise provide publish pull push put raise reach read
    realize receive remember reply report require run save say see seem sell send serve set
    share show sign sit sleep speak spend stand start stay stop study suggest support take
    talk teach tell tend test thank think touch try turn understand use visit wait walk want
    watch win wonder work worry write
    """.split()
)

# Irregular verb forms of that lexicon.
IRREGULAR = {
    "became": "become", "began": "begin", "begun": "begin", "bought": "buy",
    "broke": "break", "broken": "break", "brought": "bring", "built": "build",
    "came": "come", "chose": "choose", "chosen": "choose", "drew": "draw", "drawn": "draw",
    "driven": "drive", "drove": "drive", "ate": "eat", "eaten": "eat", "fell": "fall",
    "fallen": "fall", "felt": "feel", "forgot": "forget", "forgotten": "forget",
    "found": "find", "gave": "give", "given": "give", "gone": "go", "got": "get",
    "gotten": "get", "grew": "grow", "grown": "grow", "heard": "hear", "held": "hold",
    "kept": "keep", "knew": "know", "known": "know", "left": "leave", "lost": "lose",
    "made": "make", "meant": "mean", "met": "meet", "paid": "pay", "ran": "run",
    "said": "say", "sat": "sit", "saw": "see", "seen": "see", "sent": "send",
    "showed": "show", "shown": "show", "slept": "sleep", "sold": "sell", "spent": "spend",
    "spoke": "speak", "spoken": "speak", "stood": "stand", "taken": "take",
    "taught": "teach", "thought": "think", "told": "tell", "took": "take",
    "understood": "understand", "went": "go", "won": "win", "written": "write",
    "wrote": "write",
    "applied": "apply", "carried": "carry", "replied": "reply", "studied": "study",
    "tried": "try", "worried": "worry", "beginning": "begin", "dropped": "drop",
    "dropping": "drop", "forgetting": "forget", "getting": "get", "letting": "let",
    "planned": "plan", "planning": "plan", "preferred": "prefer", "preferring": "prefer",
    "putting": "put", "running": "run", "setting": "set", "sitting": "sit",
    "stopped": "stop", "stopping": "stop", "winning": "win",
}


def chunks(text: Column | str) -> Column:
    return F.split(text, SEPARATORS)


def chunk_tokens(chunk: Column) -> Column:
    """Tokens of one chunk. Most chunks are a token already; only the others are cut."""
    cut = chunk
    for pattern, replacement in CUTS:
        cut = F.regexp_replace(cut, pattern, replacement)
    inner = F.filter(F.split(cut, " "), lambda t: t.rlike(LETTERS_AND_DIGITS))
    whole = chunk.rlike(LETTERS_AND_DIGITS) & ~chunk.isin(*JOINED)
    return F.when(whole, F.array(chunk)).otherwise(inner)


def tokens(text: Column | str) -> Column:
    """Tokens of letters and digits, in order."""
    return F.flatten(F.transform(chunks(text), chunk_tokens))


def without_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The test is case-sensitive: a capitalized stop word stays."""
    return F.filter(words, lambda t: ~t.isin(*stop_words))


def verb_lemma(
    word: Column,
    verbs: Sequence[str] = VERBS,
    irregular: Mapping[str, str] = IRREGULAR,
) -> Column:
    """Shortest verb of the lexicon which the word may be a form of, else the word itself."""
    inflected = word.isin(*irregular)
    for ending in sorted({ending[-1] for ending, _ in VERB_ENDINGS}):
        inflected = inflected | word.endswith(ending)
    pairs = [F.lit(x) for pair in irregular.items() for x in pair]
    exception = F.when(word.isin(*irregular), F.try_element_at(F.create_map(*pairs), word))
    candidates = [word, exception]
    for ending, replacement in VERB_ENDINGS:
        stem = F.substring(word, F.lit(1), F.length(word) - len(ending))
        regular = word.endswith(ending) & exception.isNull()
        candidates.append(F.when(regular, F.concat(stem, F.lit(replacement))))
    known = F.filter(F.array(*candidates), lambda c: c.isin(*verbs))
    ranked = F.transform(known, lambda c, i: F.struct(F.length(c), i, c.alias("lemma")))
    lemma = F.coalesce(F.array_min(ranked)["lemma"], word)
    # Any other word can only be its own lemma, in the lexicon or not.
    return F.when(inflected, lemma).otherwise(word)
