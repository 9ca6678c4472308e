"""Stop words."""

from __future__ import annotations

# The Turkish stop words of the calibrated quality filter, most frequent first.
TURKISH = tuple(
    """
ve bir bu olarak ile da olan için de en türk daha amerikalı ilk tarafından büyük sonra yılında çok gibi ise
kadar arasında iki veya yer göre olduğu diğer eski futbolcu her oyuncu ancak yeni ingiliz önemli osmanlı aynı
fransız ayrıca dünya ya alman son yazar kabul genel birçok yıl devlet bazı yüksek birlikte the karşı üzerine
alan siyasetçi içinde tüm bulunan gelen yapılan birleşik sahip türkiye ortaya şekilde farklı of adlı o kendi
üzere eylül zaman üzerinde ikinci fazla küçük italyan iyi millî dış adı bağlı ocak çeşitli olduğunu tek güney
önce film kişi mayıs ödülü hem mart üç olmak özellikle özel istanbul tarihinde ekim yaklaşık devam temmuz
kaynakça kuzey eden kasım haziran şubat nisan oyuncusu aralık ağustos tarihi doğu bunun sadece biri başkanı
avrupa rus uzun ilgili şarkıcı orta doğru yeniden sinema ülkenin ülke edilen yazarı batı ardından kez
uluslararası nedeniyle bilim boyunca insan amerika başka kısa sırasında az arasındaki merkezi halk geri
genellikle söz savaş iç sahibi temel müzik eğitim ele iş elde yerine ana gün yol and süre altında dil zamanda
""".split()
)
