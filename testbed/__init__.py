"""The driver's test tables dressed up as a subscription business, and the checked queries."""
