"""Named query plans: the registry behind ``__spark_entry__``."""
