"""The registered queries of this subpackage and the SQL that some of them have."""

from __future__ import annotations

from .decontamination import op5_decontamination
from .gif import op8_gif
from .jaccard import op4_jaccard
from .langid import op2_language
from .licenses import op13_licenses
from .packing import op10_packing
from .pii import op7_pii
from .resampling import OP12_SQL, op12_resampling
from .secrets import op6_secrets
from .sharding import op9_sharding
from .token_counts import op3_token_counts
from .toxicity import op1_toxicity
from .whitening import op11_whitening

QUERIES = {f.__name__: f for f in (op1_toxicity, op2_language, op3_token_counts, op4_jaccard, op5_decontamination, op6_secrets, op7_pii, op8_gif, op9_sharding, op10_packing, op11_whitening, op12_resampling, op13_licenses)}
ORACLES: dict[str, str] = {"op12_resampling": OP12_SQL}
