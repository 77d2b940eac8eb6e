"""growthlens: growth and product analytics as native Spark DataFrame operators.

Layers (each a plain ``DataFrame -> DataFrame`` function, no UDFs):

* ``growthlens.sources``    feed schemas, readers, overwrite writers, testdata-derived feeds
* ``growthlens.functions``  Column builders (null-safe ratio, money, flags, buckets, % change)
* ``growthlens.operators``  staging cleaners, marts, weekly KPIs, data checks, dashboard datasets
* ``growthlens.plans``      end-to-end warehouse build (materialise cleaned events, write marts)
* ``growthlens.streaming``  the stateless event cleaner and daily funnel counts on a stream
"""

from growthlens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
