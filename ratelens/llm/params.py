"""Production parameters shared by the queries and the pipeline."""

N_SHARDS = 8

#: Target byte shares: the large source is cut to a fifth; sources not named share the rest by size.
MIX_WEIGHTS = {"src0": 0.20, "src1": 0.06, "src2": 0.06, "src3": 0.05, "src4": 0.05}
MIX_SEED = 17

#: a text's cosine with the best language's prototype from which it counts as language at all
MIN_LANGUAGE_SCORE = 0.05
