"""All queries of the text operators."""

import tidemark.llm.byte_bpe  # noqa: F401  registers its query
import tidemark.llm.embedding_dedup  # noqa: F401
import tidemark.llm.exact_dedup  # noqa: F401
import tidemark.llm.filter_audit  # noqa: F401
import tidemark.llm.language_id  # noqa: F401
import tidemark.llm.license_scan  # noqa: F401
import tidemark.llm.minhash_dedup  # noqa: F401
import tidemark.llm.packing  # noqa: F401
import tidemark.llm.periodic_runs  # noqa: F401
import tidemark.llm.pii  # noqa: F401
import tidemark.llm.secret_scan  # noqa: F401
import tidemark.llm.sharding  # noqa: F401
import tidemark.llm.toxicity  # noqa: F401
from tidemark.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
