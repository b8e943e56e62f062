"""Column expressions (JVM-side, codegen'd) shared by the jobs."""

from tessera.functions.text import (  # noqa: F401
    canonical_form,
    clean_gloss,
    clean_oov_word,
    clean_source,
    client_id,
    fused_confidence,
    html_to_lines,
    in_charset,
    looks_like_source,
    primary_gloss,
    quoted_target,
    slug_ascii,
    slug_speaker,
    strip_ws,
    word_tokens,
)
