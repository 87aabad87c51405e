"""JDBC round trip against a database the caller provides.

No database is started by the tests.  Set ``MEDALLION_JDBC_URL`` (and, if
needed, ``MEDALLION_JDBC_USER`` / ``MEDALLION_JDBC_PASSWORD`` /
``MEDALLION_JDBC_DRIVER``) to run it against an existing one.
"""

import os
import uuid

import pytest

from medallion.contracts import DELIVERY
from medallion.plans import queries as Q
from medallion.sinks.jdbc import contract_column_types, write_jdbc
from medallion.sources.jdbc import read_jdbc
from tests.conftest import SF_SMALL

URL = os.environ.get("MEDALLION_JDBC_URL")


@pytest.mark.skipif(not URL, reason="no database given (MEDALLION_JDBC_URL unset)")
def test_delivery_round_trip(spark):
    props = {k: os.environ[f"MEDALLION_JDBC_{k.upper()}"] for k in ("user", "password", "driver")
             if f"MEDALLION_JDBC_{k.upper()}" in os.environ}
    table = f"dlzd_test_{uuid.uuid4().hex[:8]}"
    delivery = Q.q_delivery_satisfaction(spark, SF_SMALL)
    write_jdbc(delivery, URL, table, mode="overwrite", num_partitions=4, properties=props,
               column_types={k: v for k, v in contract_column_types(DELIVERY).items() if v.startswith("VARCHAR")})
    write_jdbc(delivery, URL, table, mode="overwrite", num_partitions=4, properties=props)   # re-run: same rows
    back = read_jdbc(spark, URL, table, properties=props)
    assert back.count() == delivery.count()
    assert back.select(*delivery.columns).exceptAll(delivery).count() == 0
