"""Test damage for the text-repair operator: the repair rules backwards.

The rule for a lost letter (U+FFFD) is not the inverse of anything: the damage turns
another letter into it, so that the repair visibly puts an ``e`` with an acute there.
"""

from propyield.functions import MOJIBAKE_RULES

LOST = "\ufffd"
CORRUPTIONS = (*((good, bad) for bad, good in MOJIBAKE_RULES if bad != LOST), ("\u00eb", LOST))
