"""All registered queries."""

import workload.q_columns  # noqa: F401
import workload.q_reshape  # noqa: F401
import workload.q_groups  # noqa: F401
import workload.q_jobs  # noqa: F401
import workload.q_stats  # noqa: F401
import workload.q_sources  # noqa: F401
