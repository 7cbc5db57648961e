"""unisono: language-synchronisation analytics on PySpark."""
