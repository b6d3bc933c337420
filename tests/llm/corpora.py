"""What the tests of this folder share."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHES = (
    "id uid n name class key keys score predicted held_out kept keep_id group_size spans clean_text removed_spans "
    "text_hash host words lines component component_id unit start length bucket sequence_id offset piece label "
    "sample_id sample_label n_rows keep_key keep_hash raw bytes line u"
).split()


def words(rng: random.Random, n: int) -> str:
    syllables = "an the on ti re st ing ou ver keit eau ment".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
