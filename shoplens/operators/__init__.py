"""DataFrame -> DataFrame operators. No actions, no collect, no UDFs."""
