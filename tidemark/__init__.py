"""Customer-attrition analytics as DataFrame-in / DataFrame-out Spark operators."""
