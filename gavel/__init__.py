"""Document-record analytics on Spark: parsing, page handling, linkage, evaluation, SQL analytics and statistics."""
