"""Production parameters that the registered queries and the pipeline share."""

from __future__ import annotations

#: Target weights of the mixture; nodes that are not listed weigh 1.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {("domain0",): 5, ("domain1",): 3, ("domain2",): 2, ("en",): 5, ("de",): 3, ("fr",): 2}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 4, 11
DOMAIN = "coalesce(concat('domain', cast(try_cast(regexp_extract(source, '[0-9]+', 0) as int) % 3 as string)), 'other')"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
