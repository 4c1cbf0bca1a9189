"""Report documents survive the way through JSON."""

import tempfile

from contrail.operators import documents
from contrail.plans import registry

from .conftest import SMALL


def test_sections_read_back_as_written(spark):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    made = {**documents.realtime_documents(registry.snapshot(spark, SMALL)),
            **documents.anomaly_documents(registry._recent(spark, SMALL, 7))}
    for name, sections in made.items():
        back = documents.read_document(spark, f"{base}/{name}", documents.write_document(sections, f"{base}/{name}"))
        for section, df in sections.items():
            cols = [f.name for f in df.schema if not f.dataType.typeName() == "map"]
            assert sorted(map(str, back[section].select(cols).collect())) == sorted(map(str, df.select(cols).collect())), section
