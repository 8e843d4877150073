"""finledger: payment and bank JSON to clean, keyed, auditable ledger tables on Spark."""

__version__ = "0.1.0"
