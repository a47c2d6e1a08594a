"""Word lists used by the cleaning rules."""

# The English stop words that the token cleaning removes.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very s t can will just don should now"
).split()

# Fixed value: a mis-decoded quotation mark that one form of the list adds.
MOJIBAKE_QUOTE = "â€œ"

# The ASCII punctuation marks stripped from both ends of a token.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# A short general dictionary; a full one is read with ``sources.read_dictionary``.
COMMON_CONTRACTIONS = {
    "could've": "could have",
    "should've": "should have",
    "they'll": "they will",
    "they're": "they are",
    "they've": "they have",
    "we'll": "we will",
    "we're": "we are",
    "we've": "we have",
    "who're": "who are",
    "would've": "would have",
    "you'll": "you will",
    "you're": "you are",
    "you've": "you have",
}
