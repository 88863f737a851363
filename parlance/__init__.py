"""parlance: a PySpark-native engine for building preference data from dialogues."""
