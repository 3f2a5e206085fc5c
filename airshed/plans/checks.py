"""Check queries: the library's jobs run over the driver tables.

Each ``qNN_*`` function takes ``(spark, sf_dir)`` and returns a DataFrame;
``ORACLE`` holds the same computation as DuckDB SQL over the pre-registered
views. Column roles on the driver tables:

* ``events``: ts = measured time, user_id = station (its remainder by seven
  the place of the city-level summaries), event_type = pollutant, value =
  reading.
* ``customer`` / ``nation`` / ``region``: stations' places.
* ``orders``: official daily index feed and bulletins (priority = level).
* ``lineitem`` x ``supplier``: river readings x river stations.
* ``documents``: bulletin text; ``pages``: raw HTML.

Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from airshed.plans import (check_facts, check_gold, check_jobs, check_models, check_nested, check_recovery, check_staging,
                           check_streams)

MODULES = (check_staging, check_models, check_nested, check_facts, check_streams, check_gold, check_jobs,
           check_recovery)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
q19_monthly_index = check_gold.q19_monthly_index
