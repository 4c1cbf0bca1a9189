"""Table operators: ``DataFrame -> DataFrame`` transforms, reports and checks."""
