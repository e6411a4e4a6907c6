"""kiln: a Spark-native medallion pipeline.

Raw all-text tables (bronze) are cleaned by ordered, declarative rules into typed
tables (silver) with every rejected row quarantined with a reason (audit), rolled up
into per-entity gold products, and reconciled against silver metric by metric.
Everything is DataFrame / Spark SQL; nothing is collected to the driver.
"""

__version__ = "0.1.0"
