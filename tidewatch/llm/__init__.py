"""Training-data operators: one module each, with their queries; see ``registry``."""
