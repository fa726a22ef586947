"""Columns of the ad log and of the enriched (ODS) table."""

from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
# Prices are exact decimals, so that sums do not depend on the order of rows.
_PRICE = T.DecimalType(18, 4)

# The log's column names, in the order of the stored table. The
# four geo columns are not in the raw log; enrichment puts them there.
GEO_COLUMNS = ("longitude", "latitude", "province", "city")

_ODS_TYPES = {
    "ip": _STRING, "sessionid": _STRING,
    "advertisersid": _LONG, "adorderid": _LONG, "adcreativeid": _LONG,
    "adplatformproviderid": _LONG,
    "sdkversion": _STRING, "adplatformkey": _STRING,
    "putinmodeltype": _INT, "requestmode": _INT,
    "adprice": _PRICE, "adppprice": _PRICE,
    "requestdate": _STRING,
    "appid": _STRING, "appname": _STRING, "uuid": _STRING, "device": _STRING,
    "client": _LONG,
    "osversion": _STRING, "density": _STRING,
    "pw": _INT, "ph": _INT,
    "longitude": T.DoubleType(), "latitude": T.DoubleType(),
    "province": _STRING, "city": _STRING,
    "ispid": _INT, "ispname": _STRING,
    "networkmannerid": _INT, "networkmannername": _STRING,
    "iseffective": _INT, "isbilling": _INT,
    "adspacetype": _INT, "adspacetypename": _STRING,
    "devicetype": _LONG, "processnode": _INT, "apptype": _INT,
    "district": _STRING, "paymode": _INT, "isbid": _INT,
    "bidprice": _PRICE, "winprice": _PRICE, "iswin": _INT,
    "cur": _STRING, "rate": _PRICE, "cnywinprice": _PRICE,
    "imei": _STRING, "mac": _STRING, "idfa": _STRING, "openudid": _STRING,
    "androidid": _STRING,
    "rtbprovince": _STRING, "rtbcity": _STRING, "rtbdistrict": _STRING,
    "rtbstreet": _STRING, "storeurl": _STRING, "realip": _STRING,
    "isqualityapp": _INT, "bidfloor": _PRICE, "aw": _INT, "ah": _INT,
    "imeimd5": _STRING, "macmd5": _STRING, "idfamd5": _STRING,
    "openudidmd5": _STRING, "androididmd5": _STRING,
    "imeisha1": _STRING, "macsha1": _STRING, "idfasha1": _STRING,
    "openudidsha1": _STRING, "androididsha1": _STRING,
    "uuidunknow": _STRING, "userid": _STRING, "iptype": _INT,
    "initbidprice": _PRICE, "adpayment": _PRICE, "agentrate": _PRICE,
    "lomarkrate": _PRICE, "adxrate": _PRICE,
    "title": _STRING, "keywords": _STRING, "tagid": _STRING,
    "callbackdate": _STRING, "channelid": _STRING, "mediatype": _INT,
    "email": _STRING, "tel": _STRING, "sex": _STRING, "age": _STRING,
}

ODS_COLUMNS = tuple(_ODS_TYPES)
ODS = T.StructType([T.StructField(name, kind) for name, kind in _ODS_TYPES.items()])
AD_LOG = T.StructType([field for field in ODS if field.name not in GEO_COLUMNS])

# A row's main id is the first of these that is filled.
ID_COLUMNS = ("androidid", "openudid", "mac", "idfa", "imei")

# Keys of the stored tables.
TABLE_KEYS = {
    "ods": ("sessionid",),
    "province_city_analysis": ("province", "city"),
    "ad_region_analysis": ("province", "city"),
    "ad_channel_analysis": ("channelid",),
    "ad_device_analysis": ("client", "device"),
    "ad_network_analysis": ("networkmannerid", "networkmannername"),
    "ad_operate_analysis": ("ispname",),
    "app_analysis": ("appid", "appname"),
    "business_area": ("geohash",),
    "tag_members": ("user_id", "id"),
    "tag": ("user_id", "tag"),
}
